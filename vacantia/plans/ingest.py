"""Ingest plan: landed boards to normalized, filtered, deduplicated, new and limited job rows, with summaries and errors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import to_iso
from ..functions.geo import load_geo
from ..functions.html import html_to_text, sanitize_html
from ..functions.location import parse_locations
from ..functions.redact import redact_description, strip_contact_fields
from ..functions.salary import parse_salary
from ..functions.text import blank_to_null, change_hash, content_key, make_id, normalize_title
from ..functions.work import detect_employment, detect_remote, lookup
from ..operators.rows import Filters, dedupe_content, dedupe_first, delta, per_group_limit, upsert_seen
from ..schema import JOB_SCHEMA
from ..sources.providers import board_status, extract
from ..sources.stores import store_once


@dataclass
class Options:
    """What a run delivers; ``scraped_at`` is its one clock reading."""

    scraped_at: str
    include_description: bool = False
    description_format: str = "text"
    redact_contacts: bool = True
    include_raw: bool = False
    dedupe: str = "id"
    only_new: bool = False
    max_jobs: int = 0
    max_jobs_per_company: int = 0
    filters: Filters = field(default_factory=Filters)


def _once(value: Column) -> Column:
    """``value`` as an expression that the optimizer doesn't copy to each place that reads it, as it does with what is the same whenever computed."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def build_records(extracted: DataFrame, options: Options) -> DataFrame:
    """Job rows, in this order: description, redaction, sanitising, location, remote, employment, salary, dates, identity.

    Salary is read after redaction, so that no phone number is taken for pay. Python functions each see a row once.
    """
    e = extracted
    text_columns = [n for n, t in e.dtypes if t == "string" and n not in ("payload", "provider", "slug", "input")]
    e = e.withColumns({n: blank_to_null(n) for n in text_columns})
    e = e.withColumn("plain", F.coalesce("descriptionText", html_to_text("descriptionHtml")))
    e = e.withColumn("body", _once(redact_description("descriptionHtml", "plain", options.redact_contacts)))
    e = e.withColumn("place", _once(parse_locations("locationRaw", "extraLocations", "locationStructured")))
    e = e.withColumn("first", F.col("place.primary"))
    names = lookup(load_geo().names, F.col("countryOverride"))
    e = e.withColumn("pay", _once(parse_salary("payload", "body.text", "first.city", "first.region", "first.country", "first.countryCode", "salaryText")))
    head = "body.text" if options.include_description else None
    e = e.withColumn("remote3", detect_remote("workplaceType", "remoteFlag", "hybridFlag", "onSiteFlag", "isRemote", "first.raw", "title", head))
    e = e.withColumn("work3", detect_employment("employmentType", "title", "schedule"))
    posted = to_iso("postedAt")
    html, text = sanitize_html("body.html"), F.col("body.text")
    show = lambda c, kinds: F.when(F.lit(options.include_description and options.description_format in kinds), c)
    has_body = F.coalesce("body.html", "body.text").isNotNull()
    null = F.lit(None)
    columns = {
        "recordType": F.lit("job"), "id": make_id("provider", "slug", "sourceId"), "provider": F.col("provider"), "companySlug": F.col("slug"), "company": F.col("company"), "companyDomain": null, "title": F.col("title"), "titleNormalized": normalize_title("title", "first.city"),
        "department": F.col("department"), "team": F.col("team"), "locationRaw": F.col("first.raw"), "city": F.col("first.city"), "region": F.col("first.region"), "country": F.coalesce(names, "first.country"), "countryCode": F.coalesce("countryOverride", "first.countryCode"),
        "locations": F.col("place.locations"), "remote": F.col("remote3.remote"), "workplaceType": F.col("remote3.workplaceType"), "remoteSource": F.col("remote3.remoteSource"), "employmentType": F.col("work3.employmentType"),
        "employmentTypeRaw": F.coalesce("employmentTypeRaw", "work3.employmentTypeRaw"), "employmentTypeSource": F.col("work3.employmentTypeSource"), "seniority": F.col("seniority"), "yearsOfExperience": F.col("yearsOfExperience"), "salaryMin": F.col("pay.min"), "salaryMax": F.col("pay.max"),
        "salaryCurrency": F.col("pay.currency"), "salaryInterval": F.col("pay.interval"), "salarySource": F.col("pay.source"), "salaryRaw": F.col("pay.raw"), "url": F.col("url"), "applyUrl": F.col("applyUrl"), "postedAt": posted, "postedAtSource": F.when(posted.isNotNull(), F.col("postedAtSource")),
        "updatedAt": to_iso("updatedAt"), "descriptionHtml": show(html, ("html", "both")), "descriptionText": show(text, ("text", "both")), "descriptionRedacted": F.when(F.lit(options.include_description) & has_body, F.col("body.descriptionRedacted")), "requisitionId": F.col("requisitionId"),
        "sourceId": F.col("sourceId"), "dedupedFrom": null, "isNew": null, "firstSeenAt": null, "scrapedAt": F.lit(options.scraped_at), "raw": strip_contact_fields("payload") if options.include_raw else null, "input": F.col("input"), "warnings": F.coalesce("warnings", F.array().cast("array<string>")),
    }
    jobs = e.select("ord", "row", *[c.alias(n) for n, c in columns.items()])
    places = F.filter(F.transform("locations", lambda x: F.coalesce(x["raw"], F.array_join(F.array(x["city"], x["region"], x["country"]), ", "))), lambda x: x != "")
    keys = {"contentKey": content_key("titleNormalized", F.coalesce("company", "companySlug"), "locationRaw", "requisitionId"), "changeHash": change_hash("title", places, "department", "remote", "employmentType", "salaryMin", "salaryMax")}
    jobs = jobs.withColumns(keys)
    types = {f.split()[0]: f.split(" ", 1)[1] for f in JOB_SCHEMA.split(", ")}
    return jobs.select(*[F.col(n).cast(t).alias(n) for n, t in types.items()], "ord", "row")


def ingest(boards: DataFrame, options: Options, seen: DataFrame | None = None) -> dict[str, DataFrame]:
    """jobs (with ord and row), summaries, errors and, with ``seen``, the seen-state after the run.

    Filter, then dedupe, then delta, then the limit of each company, then that of the run; the state marks delivered rows only. Where
    new jobs alone are wanted but there is no state, nothing is delivered. Records are built and stored once, as all results are made of them.
    """
    checked = board_status(boards)
    built = store_once(build_records(extract(checked), options), "records")
    kept = dedupe_first(built.where(options.filters.predicate()), "id", ["ord", "row"])
    if options.dedupe == "content":
        kept = dedupe_content(kept.drop("dedupedFrom"), "id", "contentKey", ["ord", "row"]).select(*built.columns)
    emitted = kept
    if options.only_new:
        emitted = delta(kept, seen, "id").withColumns({"isNew": F.lit(True), "firstSeenAt": F.col("scrapedAt")}) if seen is not None else kept.limit(0)
    elif seen is not None:
        first = seen.select("id", F.col("firstSeen").alias("__first"))
        emitted = kept.join(first, "id", "left").withColumns({"isNew": F.col("__first").isNull(), "firstSeenAt": F.coalesce("__first", "scrapedAt")}).select(*built.columns)
    emitted = per_group_limit(emitted, ["provider", "companySlug"], ["ord", "row"], options.max_jobs_per_company)
    if options.max_jobs > 0:
        emitted = emitted.orderBy("ord", "row", "id").limit(options.max_jobs)
    board = ["provider", "slug"]
    count = lambda df, name: df.groupBy("provider", F.col("companySlug").alias("slug")).agg(F.count("*").alias(name))
    summaries = checked.where("status = 'ok'").select(*board, "input").join(count(built, "jobsFound"), board, "left").join(count(kept, "jobsKept"), board, "left").join(count(emitted, "jobsEmitted"), board, "left")
    out = {"jobs": emitted, "summaries": summaries.na.fill(0).withColumn("recordType", F.lit("company_summary")), "errors": checked.where("status <> 'ok'").select(F.lit("error").alias("recordType"), *board, "input", "status")}
    if seen is not None:
        out["seen"] = upsert_seen(seen, emitted.where("id <> ''").select("id", "changeHash"), options.scraped_at)
    return out
