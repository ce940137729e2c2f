"""A run's shell: its options, the companies it names, what they resolve to, and the free rows beside its jobs."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import blank, blank_to_null, fold
from ..functions.urls import DOMAIN, PROVIDERS, host_of, looks_like_url, parse_board_url, parse_prefix, pinned_ref, valid_slug

# Where an input may name companies, bounds of a run's numbers and what they are where nothing readable is given.
COMPANY_KEYS = ("companies", "queries", "companyUrls", "startUrls", "boardTokens", "siteNames", "jobBoardNames", "subdomains", "companyIdentifiers")
MAX_COMPANIES = 2000
BOUNDS = {"maxJobs": (0, 200_000), "maxJobsPerCompany": (0, 20_000), "maxConcurrency": (1, 32), "requestTimeoutSecs": (5, 120), "stateRetentionDays": (0, 730)}
WATCHLIST_CAP = 5000
LOSSY_STOPS = ("bucket_error", "finalize_error", "budget_ceiling", "run_deadline")
REF = "struct<provider:string,slug:string,site:string,region:string>"
ERROR_COLUMNS = ("recordType", "provider", "companySlug", "status", "error", "scrapedAt", "input")
SUMMARY_COLUMNS = (
    "recordType", "provider", "companySlug", "company", "companyDomain", "status", "jobsFound", "jobsKept", "newJobs", "duplicatesDropped", "trackedSince", "topDepartments",
    "scrapedAt", "input", "warnings",
)


def bounded(value, low: float, high: float, default: float) -> float:
    """A number within bounds; what isn't readable as one, infinite numbers among it, is the default."""
    try:
        number = float(value)
    except (TypeError, ValueError, OverflowError):
        number = default
    return min(high, max(low, number if math.isfinite(number) else default))


def read_numbers(raw: dict, defaults: dict[str, int]) -> dict[str, int]:
    """The bounded numbers of an input. Zero is kept; null is the default."""
    return {k: int(bounded(defaults[k] if raw.get(k) is None else raw[k], low, high, defaults[k])) for k, (low, high) in BOUNDS.items()}


def read_shard(raw: dict, most: int = 64) -> tuple[int, int]:
    """(shard, shardCount): what a run is, so that numbers out of bounds fail instead of being moved into them."""
    count, shard = int(raw.get("shardCount") or 4), int(raw.get("shard") or 0)
    if not 1 <= count <= most:
        raise ValueError(f"shardCount {count} is not between 1 and {most}")
    if not 0 <= shard < count:
        raise ValueError(f"there is no shard {shard} of {count}")
    return shard, count


def read_companies(raw: dict) -> list[str]:
    """Trimmed entries of the first key that has any, without repeats, at most MAX_COMPANIES."""
    named = next((raw[k] for k in COMPANY_KEYS if raw.get(k)), None)
    entries = [named] if isinstance(named, str) else named if isinstance(named, list) else []
    texts = ((e.get("url") or e.get("value") or e.get("slug")) if isinstance(e, dict) else e for e in entries)
    return list(dict.fromkeys(t.strip() for t in texts if isinstance(t, str) and t.strip()))[:MAX_COMPANIES]


def distinct_entries(entries: DataFrame, most: int = MAX_COMPANIES) -> DataFrame:
    """Entries (entry, ord) as :func:`read_companies` leaves them: trimmed, none empty, the first of repeats, the first ``most``."""
    own = entries.select(blank_to_null("entry").alias("entry"), "ord").where("entry is not null")
    return own.groupBy("entry").agg(F.min("ord").alias("ord")).orderBy("ord", "entry").limit(most)


def directory_index(directory: DataFrame, providers: list[str] | None = None) -> DataFrame:
    """What entries may match of a directory's good rows: kind (slug, name, domain), key, rank, and the board. Rows with a slug that no board can have are left out."""
    good = directory.where(F.coalesce("status", F.lit("ok")) == "ok").where(valid_slug("slug")).withColumn("provider", F.lower("provider"))
    if providers:
        good = good.where(F.col("provider").isin([p.lower() for p in providers]))
    keys = {"slug": F.col("slug"), "name": F.coalesce("name_norm", "name"), "domain": F.regexp_replace(fold("domain"), r"^www\.", "")}
    listed = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), fold(key).alias("key")) for rank, (kind, key) in enumerate(keys.items())])
    rows = good.select("provider", "slug", "site", "region", F.explode(listed).alias("k"))
    return rows.select("k.kind", "k.key", "k.rank", "provider", "slug", "site", "region").where("key <> ''")


def resolve(entries: DataFrame, directory: DataFrame | None, providers: list[str] | None = None, pin: str | None = None) -> DataFrame:
    """Entries (entry, ord, kept) with ref, status, message and candidates.

    A prefix, a board's URL and, where only ``pin``'s boards are read, a bare slug name a board outright, whatever ``providers`` are wanted. Everything else
    is looked up: a host as a domain, a word as a slug or name. One board is a hit; none or several are an error row's status.
    """
    none = F.lit(None).cast("string")
    prefix, url, bare = parse_prefix("entry"), parse_board_url("entry"), pinned_ref("entry", pin)
    said = F.coalesce(
        F.when(prefix.isNotNull(), F.struct(prefix["provider"].alias("provider"), prefix["slug"].alias("slug"), prefix["site"].alias("site"), none.alias("region"))),
        F.when(url.isNotNull(), F.struct(url["provider"].alias("provider"), url["slug"].alias("slug"), none.alias("site"), url["region"].alias("region"))),
        F.when(bare.isNotNull(), F.struct(bare["provider"].alias("provider"), bare["slug"].alias("slug"), none.alias("site"), none.alias("region"))),
    )
    token = F.when(looks_like_url("entry"), host_of("entry")).otherwise(F.trim("entry"))
    asked = entries.withColumn("said", said).withColumn("token", token).withColumn("is_domain", F.col("token").rlike(DOMAIN))
    asked = asked.withColumn("key", F.when(F.col("said").isNull() & (F.col("token") != ""), F.when(F.col("is_domain"), F.regexp_replace(fold("token"), r"^www\.", "")).otherwise(fold("token"))))
    if directory is None:
        found = asked.select("entry", F.lit(None).cast("array<struct<rank:int,provider:string,slug:string,site:string,region:string>>").alias("hits"))
    else:
        index = directory_index(directory, providers)
        match = (F.col("a.key") == F.col("d.key")) & (F.col("a.is_domain") == (F.col("d.kind") == "domain"))
        hits = asked.where("key is not null").select("entry", "key", "is_domain").alias("a").join(index.alias("d"), match)
        best = hits.groupBy("entry", "provider", "slug").agg(F.min(F.struct("rank", "provider", "slug", "site", "region")).alias("hit"))
        found = best.groupBy("entry").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    rows = asked.join(found, "entry", "left").withColumn("n", F.coalesce(F.size("hits"), F.lit(0)))
    hit = F.get(F.col("hits"), 0)
    ref = F.when(F.col("said").isNotNull(), F.col("said")).when(F.col("n") == 1, F.struct(hit["provider"].alias("provider"), hit["slug"].alias("slug"), hit["site"].alias("site"), hit["region"].alias("region")))
    names = F.transform("hits", lambda h: F.concat_ws(":", h["provider"], h["slug"]))
    other = F.coalesce(F.col("said.provider") != F.lit(pin), F.lit(False)) if pin else F.lit(False)
    status = (
        F.when(F.trim("entry") == "", "not_found").when(other, "not_found").when(ref.isNotNull(), "ok").when(F.col("token") == "", "not_found")
        .when(F.col("n") > 1, "unconfirmed").when(F.col("is_domain"), "unresolved_domain").otherwise("not_found")
    )
    hint = "add a career-site URL or an ATS prefix"
    message = (
        F.when(F.trim("entry") == "", "empty entry").when(other, F.concat(F.lit(f"only {pin} boards are read here; "), "entry", F.lit(" is another provider's"))).when(F.col("status") == "ok", none)
        .when(F.col("n") > 1, F.concat("entry", F.lit(" matches several companies; pick one: "), F.array_join(names, ", ")))
        .when(F.lit(directory is None), f"company directory unavailable; {hint}").when(F.col("is_domain"), hint).otherwise(F.concat(F.lit("no directory match for "), "entry", F.lit(f"; {hint}")))
    )
    rows = rows.withColumn("status", status)
    return rows.select("entry", "ord", F.when(F.col("status") == "ok", ref).alias("ref"), "status", message.alias("message"), F.when(F.col("n") > 1, names).alias("candidates"))


def error_rows(failed: DataFrame, scraped_at: str) -> DataFrame:
    """Free error rows of (provider, slug, entry, status, message); missing columns are null."""
    have = lambda c: F.col(c) if c in failed.columns else F.lit(None).cast("string")
    named = (F.lit("error"), have("provider"), have("slug"), have("status"), have("message"), F.lit(scraped_at), have("entry"))
    return failed.select(*[c.alias(n) for c, n in zip(named, ERROR_COLUMNS, strict=True)])


def resolve_all(entries: DataFrame, directory: DataFrame | None, scraped_at: str, providers: list[str] | None = None, pin: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Boards (provider, slug, site, region, input, ord) and error rows of a run's entries. Entries that name a board another has named stay, each with its input."""
    rows = resolve(distinct_entries(entries), directory, providers, pin)
    boards = rows.where("status = 'ok'").select("ref.*", F.col("entry").alias("input"), "ord")
    return boards, error_rows(rows.where("status <> 'ok'"), scraped_at)


def top_departments(jobs: DataFrame, n: int = 3) -> DataFrame:
    """(provider, companySlug, topDepartments): the commonest departments of each board, the first by name among equals."""
    sizes = jobs.where(blank("department") != "").groupBy("provider", "companySlug", "department").agg(F.count("*").alias("jobs"))
    ranked = sizes.withColumn("r", F.row_number().over(Window.partitionBy("provider", "companySlug").orderBy(F.desc("jobs"), "department"))).where(F.col("r") <= n)
    listed = F.array_sort(F.collect_list(F.struct("r", F.struct("department", "jobs").alias("d"))))
    return ranked.groupBy("provider", "companySlug").agg(F.transform(listed, lambda x: x["d"]).alias("topDepartments"))


def summary_rows(boards: DataFrame, found: DataFrame, kept: DataFrame, emitted: DataFrame, scraped_at: str, seen: DataFrame | None = None, stop: str | None = None) -> DataFrame:
    """Free summary rows of boards (provider, slug, input): counts, departments, and the status.

    A board of which a stopped run delivered less than it kept has the stop's status. With ``seen`` (provider, companySlug, firstSeen,
    jobs of the run before), a board that had jobs and has none now is warned of.
    """
    key = ["provider", "companySlug"]
    count = lambda df, name: df.groupBy(*key).agg(F.count("*").alias(name))
    rows = boards.withColumnRenamed("slug", "companySlug")
    for table in (count(found, "jobsFound"), count(kept, "jobsKept"), count(emitted, "newJobs"), top_departments(kept)):
        rows = rows.join(table, key, "left")
    rows = rows.na.fill(0, ["jobsFound", "jobsKept", "newJobs"])
    none = F.lit(None).cast("string")
    before = seen.select(*key, "firstSeen", F.col("jobs").alias("__before")) if seen is not None else None
    rows = rows.join(before, key, "left") if before is not None else rows.withColumns({"firstSeen": none, "__before": F.lit(0)})
    suspect = (F.col("jobsFound") == 0) & (F.coalesce("__before", F.lit(0)) > 0)
    columns = {
        "recordType": F.lit("company_summary"), "company": none, "companyDomain": none, "status": F.when(F.lit(stop is not None) & (F.col("newJobs") < F.col("jobsKept")), F.lit(stop)).otherwise("ok"),
        "duplicatesDropped": F.col("jobsFound") - F.col("jobsKept"), "trackedSince": F.coalesce("firstSeen", F.lit(scraped_at[:10])) if seen is not None else none, "scrapedAt": F.lit(scraped_at),
        "warnings": F.when(suspect, F.array(F.lit("empty_suspect"))),
    }
    return rows.withColumns(columns).select(*SUMMARY_COLUMNS)


def board_memory(seen: DataFrame, found: DataFrame, boards: DataFrame, today: str) -> DataFrame:
    """(provider, companySlug, firstSeen, lastSeen, jobs) after a run: boards of the run anew, others as they were."""
    key = ["provider", "companySlug"]
    now = boards.select("provider", F.col("slug").alias("companySlug")).distinct().join(found.groupBy(*key).agg(F.count("*").alias("now")), key, "left").withColumn("now", F.coalesce("now", F.lit(0)))
    return seen.join(now, key, "full_outer").select(*key, F.coalesce("firstSeen", F.lit(today)).alias("firstSeen"), F.when(F.col("now").isNotNull(), F.lit(today)).otherwise(F.col("lastSeen")).alias("lastSeen"), F.coalesce("now", "jobs").alias("jobs"))


def deliver(jobs: DataFrame, max_jobs: int = 0, chargeable: int | None = None) -> tuple[DataFrame, str | None]:
    """Job rows that a run may deliver, in their order (ord, row), and why it stops there: the budget of ``chargeable`` rows outranks ``max_jobs`` (0: no limit).

    A limit that is just reached stops a run too; rows beside jobs are free and are not counted.
    """
    limits = [x for x in (max_jobs or None, chargeable) if x is not None]
    if not limits:
        return jobs, None
    out = jobs.orderBy("ord", "row", "id").limit(min(limits))
    n = out.count()
    return out, "budget_exhausted" if chargeable is not None and n >= chargeable else "max_jobs_reached" if max_jobs and n >= max_jobs else None


def remaining(max_jobs: int, delivered: int) -> int | None:
    """Job rows still allowed; None without a limit."""
    return max(0, max_jobs - delivered) if max_jobs else None


def seed_rows(directory: DataFrame, today: str, retainable: list[str] | None = None, cap: int = WATCHLIST_CAP) -> DataFrame:
    """Watchlist rows of a directory's good boards with postings whose provider may be kept; the first of a board's spellings, at most ``cap`` in the directory's order (ord)."""
    kept = directory.where(F.coalesce("status", F.lit("ok")) == "ok").where(F.col("provider").isin(list(retainable or PROVIDERS)) & (blank("slug") != "") & (F.col("job_count") > 0))
    first = kept.groupBy("provider", fold("slug").alias("key")).agg(F.min(F.struct("ord", "slug", "site")).alias("first"))
    return first.orderBy("first.ord", "provider", "key").limit(cap).select("provider", F.col("first.slug").alias("company"), F.col("first.site").alias("site"), F.lit(today).alias("added"), F.lit("seed").alias("source"))


def ask_verdicts(candidates: DataFrame, verdicts: DataFrame, cap: int, order: list[str | Column]) -> DataFrame:
    """``candidates`` with verdict (gone, live, unknown): the first ``cap`` have the landed verdict, the rest, and those without one, are unknown.

    Places beyond the cap are counted by range, so that no task orders all candidates.
    """
    asked = candidates.orderBy(*order).limit(cap).join(verdicts, ["provider", "company", "job_id"], "left")
    keys = asked.select("provider", "company", "job_id").distinct()
    unknown = candidates.join(keys, ["provider", "company", "job_id"], "left_anti").withColumn("verdict", F.lit("unknown"))
    known = F.when(F.col("verdict").isin("gone", "live"), F.col("verdict")).otherwise("unknown")
    return asked.withColumn("verdict", known).select(*candidates.columns, "verdict").unionByName(unknown)


def directory_stats(candidates: DataFrame, probes: DataFrame) -> DataFrame:
    """Per provider: boards found, probed, ok, dead, unconfirmed, ok without postings, and whether so many of those that the provider is broken."""
    found = candidates.groupBy("provider").agg(F.count("*").alias("found"))
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    is_ok = F.col("status") == "ok"
    by = probes.groupBy("provider").agg(F.count("*").alias("probed"), *[count(F.col("status") == s).alias(s) for s in ("ok", "dead", "unconfirmed")], count(is_ok & (F.coalesce("job_count", F.lit(0)) == 0)).alias("zero_jobs"))
    rows = found.join(by, "provider", "full_outer").na.fill(0)
    return rows.withColumn("degraded", (F.col("ok") >= 10) & (F.col("zero_jobs") * 10 > F.col("ok") * 9))


def tallies(rows: DataFrame, by: str = "status") -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("n"))


def run_line(events: DataFrame, counts: DataFrame) -> DataFrame:
    """One row of a day's totals: added, removed, changed, boards and open postings."""
    names, zero = ("added", "removed", "changed", "boards", "open"), F.lit(0)
    marks = events.select(*[(F.col("ev") == k).cast("int").alias(k) for k in names[:3]], zero.alias("boards"), zero.alias("open"))
    sizes = counts.select(*[zero.alias(k) for k in names[:3]], F.lit(1).alias("boards"), F.col("open"))
    return marks.unionByName(sizes).agg(*[F.coalesce(F.sum(k), F.lit(0)).cast("bigint").alias(k) for k in names])


def kpi(runs: DataFrame, go: float, kill: float) -> DataFrame:
    """Median and sum of jobs over runs, and the verdict: GO from ``go`` jobs a run on, KILL below ``kill``, else HOLD."""
    found = runs.agg(F.count("*").alias("runs"), F.median("jobs").alias("median_jobs"), F.sum("jobs").alias("jobs"))
    return found.withColumn("verdict", F.when(F.col("median_jobs") >= go, "GO").when(F.col("median_jobs") < kill, "KILL").otherwise("HOLD"))


def should_fail(stopped: str | None, done: int, failed: int) -> bool:
    """Whether a run lost a part of its day: it stopped early, or more than one in twenty boards failed."""
    return stopped in LOSSY_STOPS or (done > 0 and failed * 20 > done)


@dataclass
class Budget:
    """What a run costs by time and traffic, against a ceiling. Prices and sizes are parameters of the platform it runs on."""

    ceiling: float
    prices: dict[str, float] = field(default_factory=lambda: {"hour": 0.20, "write": 0.05 / 1000, "read": 0.005 / 1000, "gb": 0.20})
    memory_gb: float = 0.5
    bytes_per_job: int = 7700

    def cost(self, seconds: float, reads: int = 0, writes: int = 0, jobs: int = 0, other_bytes: int = 0) -> float:
        traffic = (jobs * self.bytes_per_job + other_bytes) / 1e9
        return self.memory_gb * seconds / 3600 * self.prices["hour"] + writes * self.prices["write"] + reads * self.prices["read"] + traffic * self.prices["gb"]

    def over(self, **spent) -> bool:
        return self.cost(**spent) >= self.ceiling


def job_entries(spark: SparkSession, raw: dict) -> DataFrame:
    """Entries (entry, ord) of an input."""
    return spark.createDataFrame(list(map(tuple, map(reversed, enumerate(read_companies(raw))))), "entry string, ord int")
