"""Provider mappers: landed board bodies to one row a posting with common columns.

A board's list is exploded as JSON text, so that a field with an unexpected type is null for that posting alone. Live fetching is
left to a connector; all that a fetch can say is in the landed row's status.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import pick_date
from ..functions.html import unescape_once
from ..functions.text import blank_to_null, org_code_stripped
from ..functions.urls import PROVIDERS

#: Columns that every mapper gives, besides board columns and ``payload`` (the posting as JSON text).
EXTRACTED = {
    "sourceId": "string", "title": "string", "company": "string", "department": "string", "team": "string", "seniority": "string", "yearsOfExperience": "string", "locationRaw": "string", "extraLocations": "array<string>",
    "locationStructured": "string", "employmentType": "string", "employmentTypeRaw": "string", "schedule": "string", "salaryText": "string", "url": "string", "applyUrl": "string", "postedAt": "string", "postedAtSource": "string",
    "updatedAt": "string", "descriptionHtml": "string", "descriptionText": "string", "requisitionId": "string", "workplaceType": "string", "remoteFlag": "boolean", "hybridFlag": "boolean", "onSiteFlag": "boolean", "isRemote": "boolean",
    "countryOverride": "string", "warnings": "array<string>",
}
BOARD_COLUMNS = ("provider", "slug", "input", "ord")


def _columns(df: DataFrame, payload: str, **given: Column) -> DataFrame:
    """The common columns, null where a mapper gives none."""
    return df.select(*BOARD_COLUMNS, "row", F.col(payload).alias("payload"), *[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in EXTRACTED.items()])


def _explode(boards: DataFrame, list_schema: str, field: str, schema: str) -> DataFrame:
    """A row for each element of a board's list: ``payload`` its JSON text, ``j`` its fields."""
    items = boards.select(*BOARD_COLUMNS, F.posexplode(F.from_json("body", list_schema)[field] if field else F.from_json("body", list_schema)).alias("row", "payload"))
    return items.select("*", F.from_json("payload", schema).alias("j"))


def _lines(parts: list[Column]) -> Column:
    return blank_to_null(F.array_join(F.array_compact(F.array(*map(blank_to_null, parts))), "\n"))


def greenhouse(boards: DataFrame) -> DataFrame:
    """Departments without organisation codes, sorted; places of the offices as further locations; content unescaped once."""
    schema = (
        "id string, title string, company_name string, departments array<struct<name:string>>, offices array<struct<location:string>>, location struct<name:string>, absolute_url string, "
        "first_published string, updated_at string, requisition_id string, content string"
    )
    d = _explode(boards, "jobs array<string>", "jobs", schema)
    names = F.filter(F.transform("j.departments", lambda x: org_code_stripped(x["name"])), lambda n: n.isNotNull())
    date = pick_date(("first_published", F.col("j.first_published")), ("updated_at", F.col("j.updated_at")))
    places = F.filter(F.transform("j.offices", lambda o: blank_to_null(o["location"])), lambda n: n.isNotNull())
    return _columns(
        d, "payload", sourceId=F.col("j.id"), title=F.col("j.title"), company=F.col("j.company_name"), department=blank_to_null(F.array_join(F.array_sort(F.array_distinct(names)), " / ")), locationRaw=F.col("j.location.name"),
        extraLocations=places, url=F.col("j.absolute_url"), applyUrl=F.col("j.absolute_url"), postedAt=date["iso"], postedAtSource=date["source"], updatedAt=F.col("j.updated_at"), descriptionHtml=unescape_once(F.col("j.content")), requisitionId=F.col("j.requisition_id"),
    )


def lever(boards: DataFrame) -> DataFrame:
    """Team stands in for a missing department; lists belong to the description; the posting's country outranks the parsed one."""
    schema = (
        "id string, text string, categories struct<department:string,team:string,location:string,commitment:string,allLocations:array<string>>, allLocations array<string>, country string, workplaceType string, hostedUrl string, applyUrl string, "
        "createdAt string, description string, descriptionPlain string, additional string, additionalPlain string, lists array<struct<content:string>>, salaryDescription string"
    )
    d = _explode(boards, "array<string>", "", schema)
    body = blank_to_null(F.array_join(F.filter(F.concat(F.array("j.description"), F.coalesce(F.transform("j.lists", lambda x: x["content"]), F.array().cast("array<string>")), F.array("j.additional")), lambda x: blank_to_null(x).isNotNull()), "\n"))
    return _columns(
        d, "payload", sourceId=F.col("j.id"), title=F.col("j.text"), department=F.coalesce(blank_to_null("j.categories.department"), blank_to_null("j.categories.team")), team=F.col("j.categories.team"), locationRaw=F.col("j.categories.location"),
        extraLocations=F.coalesce("j.allLocations", "j.categories.allLocations"), employmentType=F.col("j.categories.commitment"), salaryText=F.col("j.salaryDescription"), url=F.col("j.hostedUrl"), applyUrl=F.col("j.applyUrl"), postedAt=F.col("j.createdAt"),
        postedAtSource=F.lit("createdAt"), descriptionHtml=body, descriptionText=_lines([F.col("j.descriptionPlain"), F.col("j.additionalPlain")]), workplaceType=F.col("j.workplaceType"), countryOverride=blank_to_null(F.upper("j.country")),
    )


def ashby(boards: DataFrame) -> DataFrame:
    """Unlisted postings go; each location keeps its own address by position."""
    address = "struct<postalAddress:string>"
    schema = (
        f"id string, title string, department string, team string, employmentType string, location string, address {address}, secondaryLocations array<struct<location:string,address:{address}>>, isListed boolean, isRemote boolean, workplaceType string, "
        "publishedAt string, jobUrl string, applyUrl string, descriptionHtml string, descriptionPlain string"
    )
    d = _explode(boards, "jobs array<string>", "jobs", schema).where(F.coalesce("j.isListed", F.lit(True)))
    first = F.array(F.struct(F.col("j.location").alias("location"), F.col("j.address").alias("address")))
    rest = F.coalesce("j.secondaryLocations", F.array().cast(f"array<struct<location:string,address:{address}>>"))
    places = F.transform(F.concat(first, rest), lambda x: F.struct(blank_to_null(x["location"]).alias("t"), x["address"]["postalAddress"].alias("a")))
    named = F.filter(places, lambda x: x["t"].isNotNull())
    kept = F.when(F.size(named) > 0, named).otherwise(F.filter(places, lambda x: x["a"].isNotNull()))
    d = d.withColumn("p", kept)
    addresses = F.when(F.exists("p", lambda x: x["a"].isNotNull()), F.concat(F.lit("["), F.array_join(F.transform("p", lambda x: F.coalesce(x["a"], F.lit("{}"))), ","), F.lit("]")))
    return _columns(
        d, "payload", sourceId=F.col("j.id"), title=F.col("j.title"), department=F.col("j.department"), team=F.col("j.team"), locationRaw=F.get("p", F.lit(0))["t"], extraLocations=F.when(F.size("p") > 1, F.transform(F.slice("p", F.lit(2), F.greatest(F.size("p"), F.lit(0))), lambda x: x["t"])), locationStructured=addresses,
        employmentType=F.col("j.employmentType"), url=F.col("j.jobUrl"), applyUrl=F.col("j.applyUrl"), postedAt=F.col("j.publishedAt"), postedAtSource=F.lit("publishedAt"), descriptionHtml=F.col("j.descriptionHtml"), descriptionText=F.col("j.descriptionPlain"),
        workplaceType=F.col("j.workplaceType"), isRemote=F.col("j.isRemote"),
    )


def recruitee(boards: DataFrame) -> DataFrame:
    """A trailing UTC is a zone; the schedule half of a compound code is the type, the code stays as raw; pay without numbers is none."""
    schema = (
        "id string, title string, company_name string, department string, location string, locations array<string>, employment_type_code string, remote boolean, hybrid boolean, on_site boolean, careers_url string, careers_apply_url string, "
        "published_at string, updated_at string, description string, requirements string"
    )
    d = _explode(boards, "offers array<string>", "offers", schema)
    d = d.withColumn("l", F.filter(F.transform("j.locations", lambda x: F.struct(F.from_json(x, "name string, city string, state string, country string, country_code string").alias("f"), x.alias("x"))), lambda x: F.coalesce(x["f"]["name"], x["f"]["city"], x["f"]["state"], x["f"]["country"], x["f"]["country_code"]).isNotNull()))
    d = d.withColumn("n", F.when(F.forall("l", lambda x: blank_to_null(x["f"]["name"]).isNotNull()), F.transform("l", lambda x: blank_to_null(x["f"]["name"]))).otherwise(F.array().cast("array<string>")))
    d = d.withColumn("n", F.when(F.coalesce(F.size("l"), F.lit(0)) < 1, F.array_compact(F.array(blank_to_null("j.location")))).otherwise(F.col("n")))
    zone = lambda c: F.regexp_replace(c, r"\s*UTC\s*$", "Z")
    code = F.col("j.employment_type_code")
    structured = F.when(F.size("l") > 0, F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["x"]), ","), F.lit("]")))
    return _columns(
        d, "payload", sourceId=F.col("j.id"), title=F.col("j.title"), company=F.col("j.company_name"), department=F.col("j.department"), locationRaw=F.get("n", F.lit(0)), extraLocations=F.slice("n", F.lit(2), F.greatest(F.size("n"), F.lit(0))), locationStructured=structured,
        employmentType=F.regexp_replace(code, "^(fulltime|parttime)_.*$", "$1"), employmentTypeRaw=blank_to_null(code), url=F.col("j.careers_url"), applyUrl=F.col("j.careers_apply_url"), postedAt=zone(F.col("j.published_at")), postedAtSource=F.lit("published_at"),
        updatedAt=zone(F.col("j.updated_at")), descriptionHtml=_lines([F.col("j.description"), F.col("j.requirements")]), remoteFlag=F.col("j.remote"), hybridFlag=F.col("j.hybrid"), onSiteFlag=F.col("j.on_site"),
    )


def rippling(boards: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """List rows of a posting, one a location, are merged by uuid first; a detail (provider, slug, uuid, body) overrides the list's fields, and one that failed is a warning."""
    place = "struct<label:string>"
    schema = (
        f"uuid string, name string, companyName string, board struct<title:string>, department struct<label:string,name:string,base_department:string,department_tree:array<string>>, workLocation {place}, workLocations array<string>, "
        "employmentType string, url string, createdOn string, description string, unlistedFromSearch boolean"
    )
    d = _explode(boards, "array<string>", "", schema).withColumn("uuid", F.col("j.uuid"))
    key = ["provider", "slug", "uuid"]
    labels = d.where(blank_to_null("j.workLocation.label").isNotNull()).groupBy(*key).agg(F.sort_array(F.collect_set(blank_to_null("j.workLocation.label"))).alias("labels"))
    first = d.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy("row"))).where("n = 1 or uuid is null").drop("n").join(labels, key, "left")
    warn = F.array().cast("array<string>")
    if details is not None:
        first = first.join(details.select(*key, F.col("body").alias("detail"), F.lit(True).alias("asked")), key, "left")
        merged = F.concat(F.regexp_replace("payload", r"\}\s*$", ","), F.regexp_replace("detail", r"^\s*\{", ""))
        first = first.withColumn("payload", F.when(F.col("detail").rlike(r"^\s*\{\s*\"") & F.from_json("detail", "uuid string").isNotNull(), merged).otherwise(F.col("payload"))).withColumn("j", F.from_json("payload", schema))
        warn = F.when(F.col("detail").isNull(), F.array(F.lit("detail_failed"))).otherwise(warn)
    first = first.where(~F.coalesce("j.unlistedFromSearch", F.lit(False)))
    tree = F.filter(F.transform("j.department.department_tree", lambda x: blank_to_null(x)), lambda x: x.isNotNull())
    every = F.array_distinct(F.concat(F.coalesce("labels", F.array().cast("array<string>")), F.filter(F.coalesce("j.workLocations", F.array().cast("array<string>")), lambda x: blank_to_null(x).isNotNull())))
    company = F.coalesce(blank_to_null("j.companyName"), F.col("j.board.title"))
    sections = F.coalesce(F.array_join(F.map_values(F.from_json("j.description", "map<string,string>")), "\n"), F.col("j.description"))
    # pay bands call their bounds differently; the reader's names are put beside them
    payload = F.regexp_replace(F.regexp_replace("payload", '"rangeStart"\\s*:\\s*([^,}]*)', '"rangeStart":$1,"min":$1'), '"rangeEnd"\\s*:\\s*([^,}]*)', '"rangeEnd":$1,"max":$1')
    first = first.withColumn("pay", payload)
    return _columns(
        first, "pay", sourceId=F.col("uuid"), title=F.col("j.name"), company=company, department=F.coalesce(F.get(tree, F.lit(0)), "j.department.base_department", "j.department.label"), team=F.when(F.size(tree) > 1, F.element_at(tree, -1)).otherwise(F.col("j.department.name")),
        locationRaw=F.get(every, F.lit(0)), extraLocations=every, employmentType=F.coalesce(F.get_json_object("j.employmentType", "$.id"), F.get_json_object("j.employmentType", "$.label"), F.col("j.employmentType")), url=F.col("j.url"), postedAt=F.col("j.createdOn"),
        postedAtSource=F.lit("createdOn"), descriptionHtml=sections, warnings=warn,
    )


POSITION = (
    "id string, name string, subcompany string, office string, additionalOffices struct<office:array<string>>, department string, recruitingCategory string, employmentType string, schedule string, seniority string, yearsOfExperience string, createdAt string, "
    "jobDescriptions struct<jobDescription:array<struct<name:string,value:string>>>"
)


def personio(boards: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Positions of a feed; boards mostly without bodies take missing ones from ``fallback`` (landed feeds in another language) by id."""

    def positions(b: DataFrame) -> DataFrame:
        feed = F.from_xml("body", f"position array<struct<{', '.join(f.replace(' ', ':', 1) for f in POSITION.split(', '))}>>", {"rowTag": "workzag-jobs"})
        return b.where(F.col("body").contains("<workzag-jobs") & ~F.col("body").rlike("(?i)<!(DOCTYPE|ENTITY)")).select(*BOARD_COLUMNS, F.posexplode(feed["position"]).alias("row", "j"))

    parts = lambda s: F.concat(F.coalesce(F.concat(F.lit("<h3>"), F.replace(F.replace(F.replace(s["name"], F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</h3>\n")), F.lit("")), F.coalesce(s["value"], F.lit("")))
    body = blank_to_null(F.array_join(F.transform("j.jobDescriptions.jobDescription", parts), "\n"))
    d = positions(boards).withColumn("html", body)
    if fallback is not None:
        other = positions(fallback).withColumn("other", body).select("provider", "slug", F.col("j.id").alias("fid"), "other").dropDuplicates(["provider", "slug", "fid"])
        bare = d.groupBy("provider", "slug").agg((F.count_if(F.col("html").isNull()) > F.count("*") / 2).alias("bare"))
        d = d.join(bare, ["provider", "slug"]).withColumn("fid", F.col("j.id")).join(other, ["provider", "slug", "fid"], "left").withColumn("html", F.when(F.col("bare"), F.coalesce("html", "other")).otherwise(F.col("html")))
    d = d.withColumn("payload", F.to_json("j"))
    url = F.when((F.length("slug") > 0) & (F.length("j.id") > 0), F.concat(F.lit("https://"), F.col("slug"), F.lit(".jobs.personio.de/job/"), F.col("j.id")))
    return _columns(
        d, "payload", sourceId=F.col("j.id"), title=F.col("j.name"), company=F.coalesce(blank_to_null("j.subcompany"), "slug"), department=F.coalesce(blank_to_null("j.department"), "j.recruitingCategory"), locationRaw=F.col("j.office"), extraLocations=F.col("j.additionalOffices.office"),
        employmentType=F.col("j.employmentType"), schedule=F.col("j.schedule"), seniority=F.col("j.seniority"), yearsOfExperience=F.col("j.yearsOfExperience"), url=url, postedAt=F.col("j.createdAt"), postedAtSource=F.lit("createdAt"), descriptionHtml=F.col("html"),
    )


MAPPERS: dict[str, Callable[[DataFrame], DataFrame]] = {"greenhouse": greenhouse, "lever": lever, "ashby": ashby, "recruitee": recruitee, "rippling": rippling, "personio": personio}
#: What makes a body a provider's answer at all; anything else is a parse error, not an empty board.
SHAPES = {
    "greenhouse": lambda b: F.get_json_object(b, "$.jobs").startswith("["),
    "ashby": lambda b: F.get_json_object(b, "$.jobs").startswith("["),
    "recruitee": lambda b: F.get_json_object(b, "$.offers").startswith("["),
    "lever": lambda b: F.ltrim(b).startswith("["),
    "rippling": lambda b: F.ltrim(b).startswith("["),
    "personio": lambda b: b.contains("<workzag-jobs") & ~b.rlike("(?i)<!(DOCTYPE|ENTITY)"),
}


def board_status(boards: DataFrame, disabled: tuple[str, ...] = ()) -> DataFrame:
    """Landed boards with the status that counts: the fetch's, or provider_unavailable, not_found or parse_error by the body."""
    known = [p for p in PROVIDERS if p not in disabled]
    body = F.col("body")
    shape = F.coalesce(*[F.when(F.col("provider") == p, F.coalesce(f(body), F.lit(False))) for p, f in SHAPES.items()], F.lit(False))
    missing = (F.col("provider") == "recruitee") & F.get_json_object(body, "$.error").isNotNull()
    status = F.when(~F.col("provider").isin(known), "provider_unavailable").when(F.col("status") != "ok", F.col("status")).when(missing, "not_found").when(~shape, "parse_error").otherwise("ok")
    return boards.withColumn("status", status)


def departments_by_job(boards: DataFrame) -> DataFrame:
    """(provider, slug, job_id, departments) from landed department trees; a department goes where one of its children has the posting too."""
    tree = F.from_json("body", "departments array<struct<id:bigint,name:string,child_ids:array<bigint>,jobs:array<struct<id:string>>>>")["departments"]
    d = boards.select("provider", "slug", F.explode(tree).alias("d")).select("provider", "slug", "d.id", org_code_stripped("d.name").alias("name"), "d.child_ids", F.explode("d.jobs").alias("job"))
    d = d.select("provider", "slug", "id", "name", F.coalesce("child_ids", F.array().cast("array<bigint>")).alias("kids"), F.col("job.id").alias("job_id"))
    ids = d.groupBy("provider", "slug", "job_id").agg(F.collect_set("id").alias("ids"), F.collect_set(F.struct("name", "kids")).alias("all"))
    leaves = F.filter("all", lambda x: F.size(F.array_intersect(x["kids"], F.col("ids"))) == 0)
    return ids.select("provider", "slug", "job_id", F.array_join(F.array_sort(F.array_distinct(F.transform(leaves, lambda x: x["name"]))), " / ").alias("departments"))


def extract(boards: DataFrame, mappers: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Postings of all good boards of all providers."""
    out = None
    for name, mapper in (mappers or MAPPERS).items():
        part = mapper(boards.where((F.col("provider") == name) & (F.col("status") == "ok")))
        out = part if out is None else out.unionByName(part)
    return out
