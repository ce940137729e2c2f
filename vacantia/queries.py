"""Queries of the engine's operators over the standard tables, with the same results as DuckDB SQL.

The tables hold no postings, so each operator runs over an analogue: users are boards, days are snapshot days, event types are
event kinds, orders are postings.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates, html, location, redact, salary, text, urls, work
from .operators import history, lifecycle, rows
from .plans import run
from .sources import stores

SQL: dict[str, str] = {}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _board_events(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "added").when(F.col("event_type") == "error", "removed").when(F.col("event_type") == "purchase", "changed")
    e = _t(spark, sf, "events")
    board = [F.date_format("ts", "yyyy-MM-dd").alias("d"), F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("provider"), F.col("user_id").cast("string").alias("company")]
    return e.select(*board, F.col("event_id").cast("string").alias("job_id"), kind.alias("ev"), "event_type")


def _events_counts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    e = _board_events(spark, sf)
    counts = e.groupBy("d", "provider", "company").agg(F.count_if(F.col("event_type").isin("view", "click")).alias("open"))
    return counts, e.where("ev is not null").drop("event_type")


_BOARD = """e AS (SELECT strftime(ts, '%Y-%m-%d') AS d, 'p' || (user_id % 3) AS provider, user_id::VARCHAR AS company, event_id::VARCHAR AS job_id,
  CASE event_type WHEN 'signup' THEN 'added' WHEN 'error' THEN 'removed' WHEN 'purchase' THEN 'changed' END AS ev, event_type FROM events),
c AS (SELECT d, provider, company, count(*) FILTER (event_type IN ('view', 'click')) AS open FROM e GROUP BY ALL)"""


def q01_closure_summary(spark, sf):
    counts, events = _events_counts(spark, sf)
    return history.closure_summary(counts, events)


SQL["q01_closure_summary"] = f"""WITH {_BOARD}, f AS (SELECT provider, company, min(d) AS first_d FROM c GROUP BY ALL),
t AS (SELECT d, provider, company, count(*) FILTER (ev = 'added') AS a, count(*) FILTER (ev = 'removed') AS r FROM e GROUP BY ALL)
SELECT c.d, provider, company, open, CASE WHEN c.d <> first_d THEN a END AS added, r AS removed, CASE WHEN c.d <> first_d THEN a - r END AS net
FROM c JOIN t USING (d, provider, company) JOIN f USING (provider, company) WHERE NOT (open = 0 AND r > 0)"""


def q02_first_days(spark, sf):
    return history.first_days(_events_counts(spark, sf)[0])


SQL["q02_first_days"] = f"WITH {_BOARD} SELECT provider, company, min(d) AS first_d FROM c GROUP BY ALL"


def q03_recent_days(spark, sf):
    return history.recent_days(_events_counts(spark, sf)[0], 3).select("d", "provider", "company", "open")


SQL["q03_recent_days"] = f"WITH {_BOARD}, r AS (SELECT *, dense_rank() OVER (ORDER BY d DESC) AS k FROM c) SELECT d, provider, company, open FROM r WHERE k <= 3"


def q04_trustworthy_events(spark, sf):
    counts, events = _events_counts(spark, sf)
    return history.trustworthy_events(counts, events).select("d", "provider", "company", "ev", "job_id")


SQL["q04_trustworthy_events"] = f"""WITH {_BOARD}, w AS (SELECT DISTINCT c.d, c.provider, c.company FROM c JOIN e ON e.d = c.d AND e.provider = c.provider AND e.company = c.company AND e.ev = 'removed' WHERE c.open = 0)
SELECT d, provider, company, ev, job_id FROM e WHERE ev IS NOT NULL AND NOT EXISTS (SELECT 1 FROM w WHERE w.d = e.d AND w.provider = e.provider AND w.company = e.company)"""


def q05_top_departments(spark, sf):
    return rows.top_groups(_t(spark, sf, "customer"), "c_nationkey", "c_mktsegment", "c_custkey", 3)


SQL["q05_top_departments"] = """WITH g AS (SELECT c_nationkey, c_mktsegment, count(*) AS n_rows, min(c_custkey) AS o FROM customer GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY n_rows DESC, o)::INTEGER AS rank FROM g) SELECT c_nationkey, c_mktsegment, n_rows, rank FROM r WHERE rank <= 3"""


def q06_dedupe_id(spark, sf):
    l = _t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")  # noqa: E741
    return rows.dedupe_first(l, "l_orderkey", ["l_partkey", "l_linenumber", "l_suppkey"])


SQL["q06_dedupe_id"] = "SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_suppkey) AS n FROM lineitem) WHERE n = 1"


def q07_dedupe_content(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.sha1(F.lower("text").cast("binary")).alias("content"))
    kept = rows.dedupe_content(d, "doc_id", "content", ["doc_id"])
    return kept.select("doc_id", "content", F.array_join(F.col("dedupedFrom").cast("array<string>"), "|").alias("deduped_from"))


SQL["q07_dedupe_content"] = """WITH d AS (SELECT doc_id, sha1(lower(text)) AS content FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id) AS n FROM d),
l AS (SELECT content, string_agg(doc_id::VARCHAR, '|' ORDER BY doc_id) AS deduped_from FROM r WHERE n > 1 GROUP BY content)
SELECT doc_id, content, deduped_from FROM r LEFT JOIN l USING (content) WHERE n = 1"""


def q08_max_jobs(spark, sf):
    return _t(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus").orderBy("o_custkey", "o_orderkey").limit(500)


SQL["q08_max_jobs"] = "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders ORDER BY o_custkey, o_orderkey LIMIT 500"


def q09_per_company_cap(spark, sf):
    return rows.per_group_limit(_t(spark, sf, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 3)


SQL["q09_per_company_cap"] = "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n <= 3"


def _as_jobs(spark, sf) -> DataFrame:
    """Parts in the columns that filters look at."""
    p, none = _t(spark, sf, "part"), F.lit(None).cast("string")
    kind = F.when(F.col("p_partkey") % 5 == 0, none).otherwise(F.when(F.col("p_partkey") % 2 == 0, "full_time").otherwise("contract"))
    posted = F.when(F.col("p_partkey") % 7 == 0, none).otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("p_partkey") % 28 + 1).cast("string"), 2, "0")))
    return p.select(
        "p_partkey", F.col("p_name").alias("title"), F.col("p_type").alias("department"), none.alias("team"), F.col("p_brand").alias("locationRaw"), none.alias("city"), none.alias("region"), none.alias("country"), F.when(F.col("p_size") % 2 == 0, "DE").otherwise("US").alias("countryCode"),
        F.lit(None).cast(f"array<{location.LOCATION}>").alias("locations"), F.when(F.col("p_size") % 3 == 0, None).otherwise(F.col("p_size") % 3 == 1).alias("remote"), kind.alias("employmentType"), F.when(kind.isNotNull(), "ats").alias("employmentTypeSource"), posted.alias("postedAt"),
    )


def q10_filters_conj(spark, sf):
    f = rows.Filters(title_exclude=["Red"], locations=["DE", "Brand#1"], departments=["econ", "promo", "standard"], employment_types=["full_time"], posted_after=datetime(2024, 1, 10, tzinfo=timezone.utc))
    return _as_jobs(spark, sf).where(f.predicate()).select("p_partkey", "title", "employmentType", "postedAt")


_JOBS = """j AS (SELECT p_partkey, p_name AS title, p_type, p_brand, p_size, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'full_time' ELSE 'contract' END AS "employmentType",
CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '2024-01-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0') END AS "postedAt" FROM part)"""
SQL["q10_filters_conj"] = f"""WITH {_JOBS} SELECT p_partkey, title, "employmentType", "postedAt" FROM j WHERE NOT contains(lower(title), 'red') AND (p_size % 2 = 0 OR contains(lower(p_brand), 'brand#1'))
AND (contains(lower(p_type), 'econ') OR contains(lower(p_type), 'promo') OR contains(lower(p_type), 'standard')) AND ("employmentType" IS NULL OR "employmentType" = 'full_time') AND ("postedAt" IS NULL OR "postedAt" >= '2024-01-10')"""


def q10b_remote_strict(spark, sf):
    f = rows.Filters(title_include=["widget", " "], remote_only=True, strict_employment=True, employment_types=["contract"])
    return _as_jobs(spark, sf).where(f.predicate()).select("p_partkey", "title")


SQL["q10b_remote_strict"] = f"""WITH {_JOBS} SELECT p_partkey, title FROM j WHERE contains(lower(title), 'widget') AND p_size % 3 = 1 AND "employmentType" = 'contract'"""


def _suppliers(spark, sf) -> DataFrame:
    return _t(spark, sf, "supplier").select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("provider"), F.col("s_suppkey").cast("string").alias("company"), "s_name")


def q11_blocklist_anti(spark, sf):
    blocked = _suppliers(spark, sf).where("cast(company as bigint) % 4 = 0").select("provider", "company")
    return history.publishable(_suppliers(spark, sf), blocked)


SQL["q11_blocklist_anti"] = "SELECT 'n' || s_nationkey AS provider, s_suppkey::VARCHAR AS company, s_name FROM supplier WHERE s_suppkey % 4 <> 0"


def q12_publishable(spark, sf):
    blocked = _suppliers(spark, sf).where("cast(company as bigint) % 10 = 3").select("provider", "company")
    return history.publishable(_suppliers(spark, sf), blocked, ("n1", "n2"))


SQL["q12_publishable"] = "SELECT 'n' || s_nationkey AS provider, s_suppkey::VARCHAR AS company, s_name FROM supplier WHERE s_suppkey % 10 <> 3 AND s_nationkey NOT IN (1, 2)"


def q13_degraded(spark, sf):
    e = _t(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count_if(F.col("value") > 150).alias("jobs"))
    return history.degraded(e, "event_type", "jobs", 5, 0.1)


SQL["q13_degraded"] = """WITH g AS (SELECT event_type, user_id, count(*) FILTER (value > 150) AS jobs FROM events GROUP BY ALL)
SELECT event_type, count(*) AS seen, count(*) FILTER (jobs = 0) AS zero, count(*) >= 5 AND count(*) FILTER (jobs = 0) / count(*) > 0.1 AS degraded FROM g GROUP BY event_type"""


def q14_coverage_grouping_sets(spark, sf):
    _board_events(spark, sf).createOrReplaceTempView("vacantia_board_events")
    return spark.sql("SELECT event_type, d, count(*) AS n_rows FROM vacantia_board_events GROUP BY GROUPING SETS ((event_type), (d), ())")


SQL["q14_coverage_grouping_sets"] = f"WITH {_BOARD} SELECT event_type, d, count(*) AS n_rows FROM e GROUP BY GROUPING SETS ((event_type), (d), ())"


def q15_ranked_dedupe(spark, sf):
    c = _t(spark, sf, "customer").select(F.lower("c_mktsegment").alias("slug"), F.col("c_nationkey").alias("provider"), (F.col("c_custkey") % 4).alias("rank"), F.col("c_custkey").alias("ord"), F.when(F.col("c_custkey") % 3 == 0, "eu").alias("region"))
    return rows.ranked_merge(c, ["provider", "slug"], ["rank", "ord"], ["region"])


SQL["q15_ranked_dedupe"] = """WITH c AS (SELECT lower(c_mktsegment) AS slug, c_nationkey AS provider, c_custkey % 4 AS rank, c_custkey AS ord, CASE WHEN c_custkey % 3 = 0 THEN 'eu' END AS region FROM customer),
r AS (SELECT provider, slug, arg_min(rank, (rank, ord)) AS rank, arg_min(ord, (rank, ord)) AS ord, arg_min(region, (rank, ord)) FILTER (region IS NOT NULL) AS region FROM c GROUP BY ALL)
SELECT slug, provider, rank, ord, region FROM r"""


def q16_interleave(spark, sf):
    return rows.interleave(_t(spark, sf, "part").select("p_brand", "p_partkey"), "p_brand", "p_partkey")


SQL["q16_interleave"] = "SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey)::INTEGER AS turn FROM part"


def _snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Orders as a stored state and as today's postings: some new, some gone, some with another status, some re-posted under another id."""
    o = _t(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    common = [F.lit("p").alias("provider"), (F.col("o_custkey") % 50).cast("string").alias("company")]
    prev = o.where("o_orderkey % 10 <> 0").select(
        *common, F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_orderpriority").alias("t"), F.col("o_orderstatus").alias("loc"), F.when(F.col("o_orderkey") % 4 == 0, None).otherwise(F.col("o_orderpriority")).alias("dept"), (F.col("o_orderkey") % 3 == 0).alias("remote"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("updated"), day.alias("first_seen"), day.alias("last_seen"), day.alias("posted"), F.lit("api").alias("posted_src"),
    )
    prev = prev.withColumn("h", text.state_hash("t", "loc", "dept", "remote"))
    cur = o.where("o_orderkey % 10 <> 1").select(
        *common, F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("r"), F.col("o_orderkey"))).otherwise(F.col("o_orderkey").cast("string")).alias("job_id"), F.upper("o_orderpriority").alias("t"), F.when(F.col("o_orderkey") % 7 == 0, F.concat("o_orderstatus", F.lit(" x"))).otherwise(F.col("o_orderstatus")).alias("loc"),
        F.when(F.col("o_orderkey") % 6 == 0, None).otherwise(F.col("o_orderpriority")).alias("dept"), (F.col("o_orderkey") % 3 == 0).alias("remote"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("posted"), F.lit(None).cast("string").alias("updated"),
    )
    return prev, cur


_SNAP = """a AS (SELECT (o_custkey % 50)::VARCHAR AS company, o_orderkey AS k, o_orderkey::VARCHAR AS job_id, lower(o_orderpriority) AS t, lower(o_orderstatus) AS loc, CASE WHEN o_orderkey % 4 <> 0 THEN lower(o_orderpriority) END AS dept, o_orderkey % 3 = 0 AS remote, strftime(o_orderdate, '%Y-%m-%d') AS posted FROM orders WHERE o_orderkey % 10 <> 0),
b AS (SELECT (o_custkey % 50)::VARCHAR AS company, CASE WHEN o_orderkey % 10 = 0 THEN 'r' || o_orderkey ELSE o_orderkey::VARCHAR END AS job_id, lower(o_orderpriority) AS t, lower(o_orderstatus) || CASE WHEN o_orderkey % 7 = 0 THEN ' x' ELSE '' END AS loc, CASE WHEN o_orderkey % 6 <> 0 THEN lower(o_orderpriority) END AS dept, o_orderkey % 3 = 0 AS remote FROM orders WHERE o_orderkey % 10 <> 1),
j AS (SELECT coalesce(a.company, b.company) AS company, coalesce(a.job_id, b.job_id) AS job_id, a.job_id IS NULL AS is_new, b.job_id IS NULL AS is_gone, a.loc IS DISTINCT FROM b.loc AS loc_differs, a.t AS at, a.loc AS al, a.dept AS ad, a.remote AS ar, b.t AS bt, b.loc AS bl, coalesce(b.dept, a.dept) AS bd, b.remote AS br, a.posted FROM a FULL JOIN b ON a.company = b.company AND a.job_id = b.job_id),
ev AS (SELECT *, CASE WHEN is_new THEN 'added' WHEN is_gone THEN 'removed' WHEN loc_differs THEN 'changed' END AS ev FROM j)"""


def q17_diff_full_outer(spark, sf):
    return history.diff(*_snapshots(spark, sf), "2002-01-01")[1].select("company", "job_id", "ev", "t")


SQL["q17_diff_full_outer"] = f"""WITH {_SNAP} SELECT company, job_id, ev, CASE WHEN is_gone THEN (SELECT o_orderpriority FROM orders WHERE o_orderkey::VARCHAR = job_id) ELSE upper(bt) END AS t FROM ev WHERE ev IS NOT NULL"""


def q18_changed_fields(spark, sf):
    changed = history.diff(*_snapshots(spark, sf), "2002-01-01")[1].where("ev = 'changed'")
    return changed.select("company", "job_id", F.array_join("changed", "|").alias("changed_fields"))


SQL["q18_changed_fields"] = f"WITH {_SNAP} SELECT company, job_id, 'loc' AS changed_fields FROM ev WHERE ev = 'changed'"


def q19_repost(spark, sf):
    return history.diff(*_snapshots(spark, sf), "2002-01-01")[1].where("ev = 'removed'").select("company", "job_id", "days_open")


SQL["q19_repost"] = f"""WITH {_SNAP} SELECT company, job_id, CASE WHEN NOT EXISTS (SELECT 1 FROM ev n WHERE n.ev = 'added' AND n.company = g.company AND n.bt = g.at AND n.bl = g.al AND n.br = g.ar AND (n.bd = g.ad OR n.bd IS NULL OR g.ad IS NULL))
THEN greatest(0, date_diff('day', g.posted::DATE, DATE '2002-01-01'))::INTEGER END AS days_open FROM ev g WHERE ev = 'removed'"""


def q20_days_open(spark, sf):
    o = _t(spark, sf, "orders").withColumn("p", F.when(F.col("o_orderkey") % 9 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return o.select("o_orderkey", dates.days_open(F.lit("1998-01-01"), "p").alias("days_open"), dates.days_between("p", F.lit("1998-01-01")).alias("days_between"))


SQL["q20_days_open"] = """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN date_diff('day', o_orderdate::DATE, DATE '1998-01-01') END AS n FROM orders)
SELECT o_orderkey, CASE WHEN n < 0 THEN 0 ELSE n END::INTEGER AS days_open, CASE WHEN n >= 0 THEN n END::INTEGER AS days_between FROM o"""


def _seen(spark, sf) -> DataFrame:
    e = _t(spark, sf, "events").where("ts < timestamp'2024-01-10'")
    return e.groupBy(F.col("user_id").cast("string").alias("id")).agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("firstSeen"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("lastSeen"), F.max("event_type").alias("changeHash"))


def q21_delta_anti(spark, sf):
    e = _t(spark, sf, "events").select(F.when(F.col("event_id") % 11 == 0, "").otherwise((F.col("event_id") % 400).cast("string")).alias("id"), "event_id")
    return rows.delta(e, _seen(spark, sf)).select("id", "event_id")


SQL["q21_delta_anti"] = """SELECT (event_id % 400)::VARCHAR AS id, event_id FROM events WHERE event_id % 11 <> 0 AND event_id % 400 NOT IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-10')"""


def q22_seen_upsert(spark, sf):
    new = _t(spark, sf, "events").where("ts >= timestamp'2024-01-28'").select((F.col("user_id") * 2).cast("string").alias("id"), F.col("event_type").alias("changeHash"))
    return rows.upsert_seen(_seen(spark, sf), new, "2024-01-30")


SQL["q22_seen_upsert"] = """WITH s AS (SELECT user_id::VARCHAR AS id, strftime(min(ts), '%Y-%m-%d') AS f, strftime(max(ts), '%Y-%m-%d') AS l, max(event_type) AS h FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1),
n AS (SELECT (user_id * 2)::VARCHAR AS id, max(event_type) AS h FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY 1)
SELECT id, coalesce(f, '2024-01-30') AS "firstSeen", CASE WHEN n.h IS NOT NULL THEN '2024-01-30' ELSE l END AS "lastSeen", coalesce(n.h, s.h) AS "changeHash" FROM s FULL JOIN n USING (id)"""


def q23_prune(spark, sf):
    return history.prune(_events_counts(spark, sf)[0], "2024-01-30", 10)


SQL["q23_prune"] = f"WITH {_BOARD} SELECT d, provider, company, open FROM c WHERE d >= '2024-01-20'"


def q24_purge(spark, sf):
    return history.purge(history.purge(_events_counts(spark, sf)[0], "p1"), "p2", "2")


SQL["q24_purge"] = f"WITH {_BOARD} SELECT d, provider, company, open FROM c WHERE provider <> 'p1' AND NOT (provider = 'p2' AND company = '2')"


def q25_bucket_shard(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", history.bucket_of(F.lit("customer"), F.col("c_custkey").cast("string")).alias("bucket"))
    return c.withColumn("shard", history.shard_of(F.col("bucket"), 32))


def q26_verify_fsm(spark, sf):
    prev, cur = _snapshots(spark, sf)
    prev = prev.withColumn("omitted", F.lit(0)).withColumn("unverified", (F.col("job_id").cast("bigint") % 5).cast("int"))
    state, events = history.diff(prev, cur, "2002-01-01")
    verdict = F.when(F.col("n") % 3 == 0, "gone").when(F.col("n") % 3 == 1, "live").otherwise("unknown")
    asked = prev.withColumn("n", F.floor(F.col("job_id").cast("bigint") / 10)).select("provider", "company", "job_id", verdict.alias("verdict"))
    out, _ = history.verify_removals(events, state, prev, asked)
    return out.where("ev = 'removed'").select("company", "job_id", "verified")


SQL["q26_verify_fsm"] = f"""WITH {_SNAP} SELECT company, job_id, (job_id::BIGINT // 10) % 3 = 0 AS verified FROM ev WHERE ev = 'removed' AND ((job_id::BIGINT // 10) % 3 = 0 OR ((job_id::BIGINT // 10) % 3 = 2 AND job_id::BIGINT % 5 + 1 >= 3))"""


def q27_resolve_cardinality(spark, sf):
    s = _t(spark, sf, "supplier")
    directory = s.select(F.col("s_nationkey").cast("string").alias("key"), F.lit(1).alias("rank"), F.lit("p").alias("provider"), F.lower("s_name").alias("slug")).union(s.select(F.lower("s_name"), F.lit(0), F.lit("p"), F.lower("s_name")))
    entries = s.select(F.lower("s_name").alias("entry")).union(spark.range(40).select(F.col("id").cast("string")))
    return rows.resolve_entries(entries.withColumn("key", F.col("entry")), directory)


SQL["q27_resolve_cardinality"] = """WITH k AS (SELECT lower(s_name) AS entry FROM supplier UNION ALL SELECT range::VARCHAR FROM range(40)), d AS (SELECT s_nationkey::VARCHAR AS key, lower(s_name) AS slug FROM supplier UNION ALL SELECT lower(s_name), lower(s_name) FROM supplier),
n AS (SELECT entry, count(DISTINCT slug) AS n_found, min(slug) AS slug FROM k LEFT JOIN d ON key = entry GROUP BY entry)
SELECT entry, n_found, CASE n_found WHEN 0 THEN 'not_found' WHEN 1 THEN 'ok' ELSE 'unconfirmed' END AS status, CASE WHEN n_found = 1 THEN 'p' END AS provider, CASE WHEN n_found = 1 THEN slug END AS slug FROM n"""


def q28_parse_url(spark, sf):
    board = F.concat(F.when(F.col("page_id") % 3 == 0, "https://jobs.eu.lever.co/Board").when(F.col("page_id") % 3 == 1, "https://www.boards.greenhouse.io/b-").otherwise("http://x.org/"), F.col("page_id").cast("string"), F.lit("/x?y=1"))
    u = urls.parse_board_url(board)
    return _t(spark, sf, "pages").select("page_id", urls.host_of("url").alias("host"), u["provider"].alias("provider"), u["slug"].alias("slug"), u["region"].alias("region"))


SQL["q28_parse_url"] = """SELECT page_id, lower(regexp_extract(url, '^[a-z]+://(?:www\\.)?([^/?#:@]+)', 1)) AS host, CASE page_id % 3 WHEN 0 THEN 'lever' WHEN 1 THEN 'greenhouse' END AS provider,
CASE page_id % 3 WHEN 0 THEN 'Board' || page_id WHEN 1 THEN 'b-' || page_id END AS slug, CASE page_id % 3 WHEN 0 THEN 'eu' END AS region FROM pages"""


def _posting(i: str):
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col(i).cast("string"), 12, "0"))
    base = F.when(F.col(i) % 4 == 0, "https://jobs.lever.co/Acme/").when(F.col(i) % 4 == 1, "https://ats.rippling.com/acme/jobs/").when(F.col(i) % 4 == 2, "https://boards.greenhouse.io/acme/jobs/").otherwise("https://jobs.ashbyhq.com/")
    return F.concat(base, uuid, F.lit("?src=x"))


def q29_posting_url(spark, sf):
    p = _t(spark, sf, "pages").select("page_id", _posting("page_id").alias("u"))
    ref = urls.parse_posting_url("u")
    return p.select("page_id", ref["provider"].alias("provider"), ref["company"].alias("company"), ref["job_id"].alias("job_id"), urls.unsupported_provider("u").alias("unsupported"))


SQL["q29_posting_url"] = """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'lever' WHEN 1 THEN 'rippling' END AS provider, CASE page_id % 4 WHEN 0 THEN 'Acme' WHEN 1 THEN 'acme' END AS company,
CASE WHEN page_id % 4 < 2 THEN '00000000-0000-4000-8000-' || lpad(page_id::VARCHAR, 12, '0') END AS job_id, CASE page_id % 4 WHEN 2 THEN 'greenhouse' END AS unsupported FROM pages"""


def q30_group_merge(spark, sf):
    l = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship"))  # noqa: E741
    merged = rows.group_merge(l, "l_orderkey", "ship", ["l_linenumber", "l_partkey", "l_suppkey", "ship"])
    return merged.select("l_orderkey", "l_partkey", F.array_join("labels", "|").alias("ship_dates"))


SQL["q30_group_merge"] = """SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS l_partkey, string_agg(DISTINCT strftime(l_shipdate, '%Y-%m-%d'), '|' ORDER BY strftime(l_shipdate, '%Y-%m-%d')) AS ship_dates FROM lineitem GROUP BY l_orderkey"""


def _enriched(spark, sf) -> DataFrame:
    e = _t(spark, sf, "events").select("event_id", (F.col("event_id") % 60).alias("u"))
    url = F.concat(F.lit("https://jobs.lever.co/c"), (F.col("u") % 6).cast("string"), F.lit("/00000000-0000-4000-8000-"), F.lpad(F.col("u").cast("string"), 12, "0"))
    e = e.withColumn("url", F.when(F.col("u") % 10 == 9, "https://acme.recruitee.com/o/x").when(F.col("u") % 10 == 8, "none").otherwise(url))
    ref = urls.parse_posting_url("url")
    e = e.select("event_id", "u", "url", ref["provider"].alias("provider"), ref["company"].alias("company"), ref["job_id"].alias("job_id"), urls.unsupported_provider("url").alias("unsupported"))
    ids = spark.range(60).where("id % 6 < 4 and id % 5 <> 0")
    state = ids.select(F.lit("lever").alias("provider"), F.concat(F.lit("c"), (F.col("id") % 6).cast("string")).alias("company"), F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("job_id"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))).alias("posted"), F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")).alias("first_seen"))
    boards, jobs = lifecycle.flatten_index(history.age_index(state))
    return lifecycle.enrich(e, boards, jobs, "2024-01-20", "event_id")


def q31_left_lookup_enrich(spark, sf):
    return _enriched(spark, sf).select("event_id", "coverage", "ageDays", "ageBasis", F.col("duplicateOf").isNotNull().alias("duplicate"), "chargeable")


SQL["q31_left_lookup_enrich"] = """WITH e AS (SELECT event_id, event_id % 60 AS u FROM events), s AS (SELECT range AS u, range % 6 AS c, CASE WHEN range % 7 <> 0 THEN range % 28 + 1 END AS posted, range % 20 + 1 AS seen FROM range(60) WHERE range % 6 < 4 AND range % 5 <> 0),
t AS (SELECT c, min(seen) AS since FROM s GROUP BY c), r AS (SELECT e.event_id, e.u, posted, seen, since, CASE WHEN e.u % 10 = 9 THEN 'unsupported_provider' WHEN e.u % 10 = 8 THEN 'unresolved_url' WHEN since IS NULL THEN 'board_untracked' WHEN s.u IS NULL THEN 'job_unknown' ELSE 'tracked' END AS coverage,
e.u % 10 < 8 AND row_number() OVER (PARTITION BY e.u ORDER BY e.event_id) > 1 AS duplicate FROM e LEFT JOIN s ON s.u = e.u LEFT JOIN t ON t.c = e.u % 6),
a AS (SELECT *, CASE WHEN coverage = 'tracked' THEN CASE WHEN posted IS NOT NULL THEN CASE WHEN posted <= 20 THEN 20 - posted END WHEN seen <= 20 THEN 20 - seen END END::INTEGER AS "ageDays", CASE WHEN coverage = 'tracked' THEN CASE WHEN posted IS NOT NULL THEN 'board' WHEN seen <= since THEN 'observed_floor' ELSE 'observed' END END AS "ageBasis" FROM r)
SELECT event_id, coverage, "ageDays", "ageBasis", duplicate, coverage = 'tracked' AND "ageDays" IS NOT NULL AND coalesce("ageBasis" IN ('board', 'observed'), false) AND NOT duplicate AS chargeable FROM a"""


def q32_age_index_nest(spark, sf):
    o = _t(spark, sf, "orders").select(F.lit("p").alias("provider"), (F.col("o_custkey") % 40).cast("string").alias("company"), F.col("o_orderkey").cast("string").alias("job_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("first_seen"))
    return history.age_index(o).select("p", "c", "t", F.array_join(F.transform("j", lambda x: F.concat_ws(",", x["job_id"], x["posted"], x["first_seen"])), ";").alias("j"))


SQL["q32_age_index_nest"] = """WITH o AS (SELECT (o_custkey % 40)::VARCHAR AS c, o_orderkey::VARCHAR AS k, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders) SELECT 'p' AS p, c, min(d) AS t, string_agg(k || ',' || d || ',' || d, ';' ORDER BY k) AS j FROM o GROUP BY c"""


def q33_kpi_median(spark, sf):
    runs = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("jobs"))
    k = runs.agg(F.median("jobs").alias("median_jobs"), F.sum("jobs").alias("total_jobs"), F.count("*").alias("runs"), F.count_if(F.col("jobs") >= 10).alias("paid"))
    verdict = F.when((F.col("paid") >= 10) & (F.col("runs") >= 3), "GO").when(F.col("runs") < 30, "KILL").otherwise("HOLD")
    return k.withColumn("verdict", verdict)


SQL["q33_kpi_median"] = """WITH r AS (SELECT o_custkey, count(*) AS jobs FROM orders GROUP BY 1), k AS (SELECT median(jobs)::DOUBLE AS median_jobs, sum(jobs)::BIGINT AS total_jobs, count(*) AS runs, count(*) FILTER (jobs >= 10) AS paid FROM r)
SELECT *, CASE WHEN paid >= 10 AND runs >= 3 THEN 'GO' WHEN runs < 30 THEN 'KILL' ELSE 'HOLD' END AS verdict FROM k"""


def q34_canon(spark, sf):
    p = _t(spark, sf, "part").withColumn("raw", F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t  "), "p_brand", F.lit(" Inc. LTD")))
    return p.select("p_partkey", text.canon("raw").alias("canon"), text.canon_company("raw").alias("company"), text.normalize_title(F.concat("p_name", F.lit(" - Berlin (Remote) #12345")), F.lit("Berlin")).alias("title"))


SQL["q34_canon"] = "SELECT p_partkey, lower(p_name) || ' ' || lower(p_brand) || ' inc. ltd' AS canon, regexp_replace(lower(p_name) || ' ' || lower(p_brand), '[^a-z0-9 ]', ' ', 'g') AS company, lower(p_name) AS title FROM part"


def q35_content_key(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", text.content_key("p_name", "p_type", "p_brand", F.col("p_size").cast("string")).alias("content_key"))


SQL["q35_content_key"] = "SELECT p_partkey, substr(sha1(concat_ws('|', lower(p_name), lower(p_type), lower(p_brand), p_size::VARCHAR)), 1, 16) AS content_key FROM part"


def q36_change_hash(spark, sf):
    c = text.change_hash("p_name", F.array("p_brand", F.lit(None), "p_type", F.lower("p_brand")), "p_type", F.col("p_size") % 2 == 0, F.lit(None).cast("string"), F.col("p_size").cast("double"), F.lit(None).cast("double"))
    return _t(spark, sf, "part").select("p_partkey", c.alias("change_hash"), text.state_hash("p_name", "p_brand", "p_type", F.lit(None).cast("boolean")).alias("state_hash"))


SQL["q36_change_hash"] = """SELECT p_partkey, substr(sha1(concat_ws('|', lower(p_name), array_to_string(list_sort(list_distinct([lower(p_brand), lower(p_type)])), '|'), lower(p_type), CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END, '', p_size || '.00', '')), 1, 8) AS change_hash,
substr(sha1(concat_ws('|', lower(p_name), lower(p_brand), lower(p_type), '')), 1, 8) AS state_hash FROM part"""


def q37_dates(spark, sf):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.unix_timestamp("o_orderdate").cast("string")).when(k == 1, (F.unix_timestamp("o_orderdate") * 1000).cast("string")).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss+02:00")).when(k == 3, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("Posted 30+ Days Ago")
    picked = dates.pick_date(("first", raw), ("second", F.date_format("o_orderdate", "yyyy-MM-dd")))
    return _t(spark, sf, "orders").select("o_orderkey", dates.to_iso(raw).alias("iso"), dates.to_day(raw).alias("day"), picked["source"].alias("source"))


SQL["q37_dates"] = """WITH o AS (SELECT o_orderkey, o_orderkey % 5 AS k, o_orderdate - CASE WHEN o_orderkey % 5 = 2 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS ts FROM orders)
SELECT o_orderkey, CASE WHEN k < 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS iso, CASE WHEN k < 4 THEN strftime(ts, '%Y-%m-%d') END AS day, CASE WHEN k < 4 THEN 'first' ELSE 'second' END AS source FROM o"""


def q38_html_to_text(spark, sf):
    return _t(spark, sf, "pages").select("page_id", html.html_to_text("html").alias("text")).select("page_id", F.length("text").alias("n_chars"), F.sha1(F.col("text").cast("binary")).alias("text_sha1"))


def q39_sanitize_html(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.sha1(html.sanitize_html("html").cast("binary")).alias("html_sha1"))


SQL["q39_sanitize_html"] = r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<\s*script\b[^>]*>.*?<\s*/\s*script\s*>|<\s*style\b[^>]*>.*?<\s*/\s*style\s*>|<\s*iframe\b[^>]*>.*?<\s*/\s*iframe\s*>|<\s*form\b[^>]*>.*?<\s*/\s*form\s*>|<\s*noscript\b[^>]*>.*?<\s*/\s*noscript\s*>', '', 'g'),
'(?is)<\s*/?\s*(script|style|iframe|object|embed|form|template|noscript|link|meta|base)\b[^>]*>', '', 'g') AS h FROM pages)
SELECT page_id, sha1(regexp_replace(regexp_replace(h, '(?is)\s+on[a-z]+\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s>]+)', '', 'g'), '(?is)((?:href|src|action|formaction)\s*=\s*["'']?)\s*(?:javascript|vbscript|data):[^"''\s>]*', '\1#', 'g')) AS html_sha1 FROM p"""


def q40_redact(spark, sf):
    r = _t(spark, sf, "documents").select("doc_id", "text", redact.redact_text("text").alias("r"))
    return r.select("doc_id", (F.col("r") != F.col("text")).alias("changed"), F.sha1(F.col("r").cast("binary")).alias("redacted_sha1"))


def q41_employment_title(spark, sf):
    titles = F.concat("p_name", F.element_at(F.array(*map(F.lit, (" Intern", " contractor", " part-time", " fixed term", " internal"))), (F.col("p_partkey") % 5 + 1).cast("int")))
    raw = F.when(F.col("p_partkey") % 3 == 0, F.element_at(F.array(*map(F.lit, ("Full-Time", "SALARIED_FT", "Permanent", "odd"))), (F.col("p_size") % 4 + 1).cast("int")))
    e = work.detect_employment(raw, titles)
    return _t(spark, sf, "part").select("p_partkey", e["employmentType"].alias("kind"), e["employmentTypeSource"].alias("source"))


SQL["q41_employment_title"] = """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_size % 4 < 3 THEN 'full_time' ELSE 'other' END ELSE CASE p_partkey % 5 WHEN 0 THEN 'internship' WHEN 1 THEN 'contract' WHEN 2 THEN 'part_time' WHEN 3 THEN 'temporary' END END AS kind,
CASE WHEN p_partkey % 3 = 0 THEN 'ats' WHEN p_partkey % 5 < 4 THEN 'title' END AS source FROM part"""


def q42_remote_ladder(spark, sf):
    k = (F.col("p_partkey") % 7 + 1).cast("int")
    place = F.element_at(F.array(*map(F.lit, ("Remote - EMEA", "Hybrid, Berlin", "Berlin (On-site)", "EMEA", "Berlin", "Paris", "work from home, UK"))), k)
    title = F.when(F.col("p_partkey") % 7 == 4, "Remote engineer").otherwise(F.col("p_name"))
    r = work.detect_remote(workplace_type=F.when(F.col("p_size") % 10 == 0, "On-Site"), location=place, title=title)
    return _t(spark, sf, "part").select("p_partkey", r["remote"].alias("remote"), r["workplaceType"].alias("workplace"), r["remoteSource"].alias("source"))


SQL["q42_remote_ladder"] = """WITH p AS (SELECT p_partkey, p_partkey % 7 AS k, p_size % 10 = 0 AS ats FROM part)
SELECT p_partkey, CASE WHEN ats THEN false WHEN k IN (0, 4, 6) THEN true WHEN k IN (1, 2) THEN false END AS remote, CASE WHEN ats OR k = 2 THEN 'onsite' WHEN k IN (0, 4, 6) THEN 'remote' WHEN k = 1 THEN 'hybrid' END AS workplace,
CASE WHEN ats THEN 'ats' WHEN k IN (0, 1, 2, 6) THEN 'location' WHEN k = 4 THEN 'title' END AS source FROM p"""


def q43_salary_text(spark, sf):
    k = F.col("o_orderkey") % 6
    n = (F.col("o_orderkey") % 90 + 10).cast("string")
    t = F.when(k == 0, F.concat(F.lit("$"), n, F.lit("k - $"), n, F.lit("k"))).when(k == 1, F.concat(F.lit("EUR "), n, F.lit(",000 to "), n, F.lit(",500 per year"))).when(k == 2, F.concat(F.lit("bonus "), n, F.lit("k - 200k"))).when(k == 3, F.lit("from 1990 - 2000")).when(k == 4, F.concat(F.lit("£"), n, F.lit(" - £"), n, F.lit(" per hour"))).otherwise("no pay")
    s = salary.parse_salary_text(t)
    return _t(spark, sf, "orders").select("o_orderkey", s.alias("s")).select("o_orderkey", "s.min", "s.max", "s.currency", "s.interval", "s.source")


SQL["q43_salary_text"] = """WITH o AS (SELECT o_orderkey, o_orderkey % 6 AS k, (o_orderkey % 90 + 10)::DOUBLE AS n FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN n * 1000 WHEN 1 THEN n * 1000 WHEN 4 THEN n END AS min, CASE k WHEN 0 THEN n * 1000 WHEN 1 THEN n * 1000 + 500 WHEN 4 THEN n END AS max, CASE k WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 4 THEN 'GBP' END AS currency,
CASE k WHEN 0 THEN 'year' WHEN 1 THEN 'year' WHEN 4 THEN 'hour' END AS interval, CASE WHEN k IN (0, 1, 4) THEN 'parsed' END AS source FROM o"""


def q44_location_parse(spark, sf):
    names = ("Berlin, Germany", "San Francisco, CA", "London", "Remote - US", "Tokyo, Japan; Singapore", "Germany, Munich", "EMEA", "Sydney, NSW, Australia")
    raw = F.element_at(F.array(*map(F.lit, names)), (F.col("s_suppkey") % 8 + 1).cast("int"))
    p = _t(spark, sf, "supplier").select("s_suppkey", location.parse_locations(raw).alias("l"))
    return p.select("s_suppkey", "l.primary.city", "l.primary.region", "l.primary.countryCode", F.size("l.locations").alias("n_locations"))


SQL["q44_location_parse"] = """WITH s AS (SELECT s_suppkey, s_suppkey % 8 AS k FROM supplier) SELECT s_suppkey, CASE k WHEN 0 THEN 'Berlin' WHEN 1 THEN 'San Francisco' WHEN 2 THEN 'London' WHEN 4 THEN 'Tokyo' WHEN 5 THEN 'Munich' WHEN 7 THEN 'Sydney' END AS city, CASE k WHEN 1 THEN 'CA' WHEN 7 THEN 'NSW' END AS region,
CASE k WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 3 THEN 'US' WHEN 4 THEN 'JP' WHEN 5 THEN 'DE' WHEN 7 THEN 'AU' END AS "countryCode", CASE k WHEN 4 THEN 2 ELSE 1 END::INTEGER AS n_locations FROM s"""


def q45_unions(spark, sf):
    c = _t(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return c.unionByName(_t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")), allowMissingColumns=True)


SQL["q45_unions"] = "SELECT c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS key FROM customer UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier"


def q46_prior_merge(spark, sf):
    c = _t(spark, sf, "customer")
    cols = [F.col("c_custkey").alias("key"), F.lit("2024-01-02").alias("first_seen"), F.col("c_mktsegment").alias("status")]
    return rows.prior_merge(c.where("c_custkey % 3 <> 0").select(cols[0], F.lit("2024-01-01").alias("first_seen"), F.lit("old").alias("status")), c.where("c_custkey % 2 = 0").select(*cols), ["key"])


SQL["q46_prior_merge"] = "SELECT c_custkey AS key, CASE WHEN c_custkey % 3 <> 0 THEN '2024-01-01' ELSE '2024-01-02' END AS first_seen, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'old' END AS status FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0"


def q47_overwrite_union(spark, sf):
    c = _t(spark, sf, "customer")
    return rows.overwrite_union([c.select("c_custkey", F.lit("a").alias("v")), c.where("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, "b").alias("v"))], ["c_custkey"])


SQL["q47_overwrite_union"] = "SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN 'a' WHEN c_custkey % 4 = 0 THEN 'b' END AS v FROM customer"


def q48_left_fill(spark, sf):
    o = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("s"))
    c = _t(spark, sf, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("s"))
    left, right = rows.left_fill(o, c, ["o_custkey"], ["s"]), rows.left_fill(o, c, ["o_custkey"], ["s"], prefer="right")
    return left.select("o_orderkey", "s", F.lit("left").alias("prefer")).union(right.select("o_orderkey", "s", F.lit("right")))


SQL["q48_left_fill"] = """WITH j AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS s, c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS r FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 3 = 0)
SELECT o_orderkey, coalesce(s, r) AS s, 'left' AS prefer FROM j UNION ALL SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN r ELSE s END, 'right' FROM j"""


def q49_guard_day(spark, sf):
    e = _t(spark, sf, "events")
    boards = e.groupBy((F.col("user_id") % 4).cast("string").alias("provider"), F.col("user_id").cast("string").alias("company")).agg(F.when(F.max("event_id") % 5 == 0, "timeout").otherwise("ok").alias("fetch_status"), F.count_if(F.col("value") > 300).alias("jobs"))
    old = e.groupBy((F.col("user_id") % 4).cast("string").alias("provider"), F.col("user_id").cast("string").alias("company")).agg(F.when(F.min("event_id") % 2 == 0, "empty_suspect").otherwise("ok").alias("status"), (F.min("event_id") % 8).alias("consecutive_failures"), F.count("*").alias("open"))
    bad = spark.createDataFrame([("3",)], "provider string")
    return history.guard_day(boards, old, bad)


SQL["q49_guard_day"] = """WITH g AS (SELECT (user_id % 4)::VARCHAR AS provider, user_id::VARCHAR AS company, CASE WHEN max(event_id) % 5 = 0 THEN 'timeout' ELSE 'ok' END AS fetch_status, count(*) FILTER (value > 300) AS jobs, CASE WHEN min(event_id) % 2 = 0 THEN 'empty_suspect' ELSE 'ok' END AS was, min(event_id) % 8 AS fails FROM events GROUP BY user_id),
a AS (SELECT *, CASE WHEN provider = '3' THEN 'skip_degraded' WHEN fetch_status <> 'ok' THEN 'keep_failed' WHEN jobs = 0 AND was <> 'empty_suspect' THEN 'mark_suspect' ELSE 'diff' END AS action FROM g),
n AS (SELECT *, CASE action WHEN 'keep_failed' THEN fails + 1 WHEN 'skip_degraded' THEN fails ELSE 0 END AS consecutive_failures FROM a)
SELECT provider, company, fetch_status, jobs, action, CASE action WHEN 'mark_suspect' THEN 'empty_suspect' WHEN 'diff' THEN 'ok' ELSE was END AS status, consecutive_failures, consecutive_failures >= 7 AS stale FROM n"""


def _directory(spark, sf) -> DataFrame:
    s = _t(spark, sf, "supplier").withColumn("n", F.col("s_suppkey").cast("bigint"))
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    return s.select(
        F.element_at(F.array(*map(F.lit, ("greenhouse", "lever", "ashby"))), (F.col("n") % 3 + 1).cast("int")).alias("provider"), text("Board", F.col("n")).alias("slug"), F.lit(None).cast("string").alias("site"), F.lit(None).cast("string").alias("region"),
        text("Firm ", F.floor(F.col("n") / 2)).alias("name"), text("firm ", F.floor(F.col("n") / 2)).alias("name_norm"), text("b", F.col("n"), ".example.org").alias("domain"), F.when(F.col("n") % 11 == 0, "dead").otherwise("ok").alias("status"),
        (F.col("n") % 4).alias("job_count"), F.col("n").alias("ord"),
    )


_DIRECTORY = """d AS (SELECT CASE s_suppkey % 3 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' ELSE 'ashby' END AS provider, 'Board' || s_suppkey AS slug, 'firm ' || (s_suppkey // 2) AS name_norm,
  'b' || s_suppkey || '.example.org' AS domain, CASE WHEN s_suppkey % 11 = 0 THEN 'dead' ELSE 'ok' END AS status, s_suppkey % 4 AS job_count, s_suppkey AS ord FROM supplier)"""


def q50_resolve_entries(spark, sf):
    """Prefixes, board URLs, slugs, names and domains against a directory."""
    c = _t(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("c"))
    n = (F.col("c") % 300).cast("string")
    entry = F.concat(F.element_at(F.array(*map(F.lit, ("lever:acme", "https://jobs.lever.co/x", "BOARD", " Firm ", "https://www.b", "jobs.lever.co/acme%20"))), (F.col("c") % 6 + 1).cast("int")), n, F.when(F.col("c") % 6 == 4, ".example.org/jobs").otherwise(""))
    entries = c.select(entry.alias("entry"), F.col("c").alias("ord")).groupBy("entry").agg(F.min("ord").alias("ord"))
    return run.resolve(entries, _directory(spark, sf)).select("entry", "status", F.col("ref.provider").alias("provider"), F.col("ref.slug").alias("slug"), F.size(F.coalesce("candidates", F.array().cast("array<string>"))).alias("n_candidates"))


SQL["q50_resolve_entries"] = "WITH " + _DIRECTORY + """, e AS (SELECT DISTINCT c_custkey % 6 AS k, c_custkey % 300 AS n FROM customer),
h AS (SELECT e.k, e.n, count(*) AS hits, min(d.provider) AS provider, min(d.slug) AS slug FROM e JOIN d ON d.status = 'ok' AND CASE e.k WHEN 2 THEN lower(d.slug) = 'board' || e.n WHEN 3 THEN d.name_norm = 'firm ' || e.n WHEN 4 THEN d.domain = 'b' || e.n || '.example.org' ELSE false END GROUP BY ALL)
SELECT CASE e.k WHEN 0 THEN 'lever:acme' WHEN 1 THEN 'https://jobs.lever.co/x' WHEN 2 THEN 'BOARD' WHEN 3 THEN ' Firm ' WHEN 4 THEN 'https://www.b' ELSE 'jobs.lever.co/acme%20' END || e.n || CASE WHEN e.k = 4 THEN '.example.org/jobs' ELSE '' END AS entry,
CASE WHEN e.k < 2 OR hits = 1 THEN 'ok' WHEN hits > 1 THEN 'unconfirmed' WHEN e.k >= 4 THEN 'unresolved_domain' ELSE 'not_found' END AS status,
CASE WHEN e.k < 2 THEN 'lever' WHEN hits = 1 THEN provider END AS provider, CASE e.k WHEN 0 THEN 'acme' || e.n WHEN 1 THEN 'x' || e.n ELSE CASE WHEN hits = 1 THEN slug END END AS slug,
CASE WHEN hits > 1 THEN hits ELSE 0 END::INTEGER AS n_candidates FROM e LEFT JOIN h USING (k, n)"""


def q51_directory_stats(spark, sf):
    """Boards and probe results of each provider."""
    d = _directory(spark, sf)
    probes = d.where(F.col("ord") % 5 > 0).withColumn("status", F.when(F.col("ord") % 5 == 1, "unconfirmed").otherwise(F.col("status"))).withColumn("job_count", F.when((F.col("provider") == "ashby") | (F.col("job_count") == 0), None).otherwise(F.col("job_count")))
    return run.directory_stats(d, probes)


SQL["q51_directory_stats"] = "WITH " + _DIRECTORY + """, p AS (SELECT provider, CASE WHEN ord % 5 = 1 THEN 'unconfirmed' ELSE status END AS status, CASE WHEN provider = 'ashby' THEN 0 ELSE job_count END AS jobs FROM d WHERE ord % 5 > 0),
f AS (SELECT provider, count(*) AS found FROM d GROUP BY 1), c AS (SELECT provider, count(*) AS probed, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'dead') AS dead, count(*) FILTER (status = 'unconfirmed') AS unconfirmed,
count(*) FILTER (status = 'ok' AND jobs = 0) AS zero_jobs FROM p GROUP BY 1) SELECT *, ok >= 10 AND zero_jobs > 0.9 * ok AS degraded FROM f JOIN c USING (provider)"""


def q52_seed_rows(spark, sf):
    """Watchlist rows of a directory."""
    return run.seed_rows(_directory(spark, sf), "2026-01-01", ["greenhouse", "ashby"])


SQL["q52_seed_rows"] = "WITH " + _DIRECTORY + """ SELECT provider, slug AS company, NULL::VARCHAR AS site, '2026-01-01' AS added, 'seed' AS source FROM d
WHERE status = 'ok' AND provider IN ('greenhouse', 'ashby') AND job_count > 0 ORDER BY ord LIMIT 5000"""


def q53_run_line(spark, sf):
    """Totals of all days and boards in one row."""
    counts, events = _events_counts(spark, sf)
    return run.run_line(events, counts)


SQL["q53_run_line"] = "WITH " + _BOARD + """ SELECT (SELECT count(*) FROM e WHERE ev = 'added') AS added, (SELECT count(*) FROM e WHERE ev = 'removed') AS removed, (SELECT count(*) FROM e WHERE ev = 'changed') AS changed,
(SELECT count(*) FROM c) AS boards, (SELECT coalesce(sum(open), 0) FROM c)::BIGINT AS open"""


def q54_company_summaries(spark, sf):
    """Free summary rows: boards are users, found postings their events, kept ones purchases and errors, delivered ones purchases."""
    e = _t(spark, sf, "events").select(F.lit("lever").alias("provider"), F.col("user_id").cast("string").alias("companySlug"), "event_type", F.col("event_type").alias("department"))
    boards = e.select("provider", F.col("companySlug").alias("slug")).distinct().withColumn("input", F.col("slug"))
    seen = boards.select("provider", F.col("slug").alias("companySlug"), F.lit("2025-12-01").alias("firstSeen"), F.lit(1).alias("jobs"))
    kept = e.where("event_type in ('purchase', 'error')")
    rows = run.summary_rows(boards, e.where("event_type <> 'view'"), kept, kept.where("event_type = 'purchase'"), "2026-01-01T00:00:00Z", seen, "max_jobs_reached")
    return rows.select("companySlug", "status", "jobsFound", "jobsKept", "newJobs", "duplicatesDropped", "trackedSince", F.get(F.col("topDepartments"), 0)["department"].alias("top"), F.coalesce(F.get(F.col("warnings"), 0), F.lit("")).alias("warning"))


SQL["q54_company_summaries"] = """WITH b AS (SELECT user_id::VARCHAR AS "companySlug", count(*) FILTER (event_type <> 'view') AS f, count(*) FILTER (event_type = 'purchase') AS p, count(*) FILTER (event_type = 'error') AS x FROM events GROUP BY 1)
SELECT "companySlug", CASE WHEN x > 0 THEN 'max_jobs_reached' ELSE 'ok' END AS status, f AS "jobsFound", p + x AS "jobsKept", p AS "newJobs", f - p - x AS "duplicatesDropped", '2025-12-01' AS "trackedSince",
CASE WHEN p + x = 0 THEN NULL WHEN p > x THEN 'purchase' ELSE 'error' END AS top, CASE WHEN f = 0 THEN 'empty_suspect' ELSE '' END AS warning FROM b"""


def q55_decode_history(spark, sf):
    """JSON lines from stored values, some quoted as one string, some cut off."""
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").cast("bigint").alias("k"))
    line = F.concat(F.lit('{"id":'), F.col("k").cast("string"), F.lit(',"t":"a b"}\n'), F.when(F.col("k") % 3 == 0, '{"id":1').otherwise('{"id":-1,"t":null}'))
    value = F.when(F.col("k") % 4 == 1, F.concat(F.lit('"'), F.replace(F.replace(line, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit('"'))).otherwise(line)
    return stores.decode_values(o.select(F.col("k").alias("key"), value.alias("value")), "id bigint, t string").select("key", "id", "t")


SQL["q55_decode_history"] = """SELECT o_orderkey::BIGINT AS key, o_orderkey::BIGINT AS id, 'a b' AS t FROM orders UNION ALL SELECT o_orderkey::BIGINT, -1::BIGINT, NULL FROM orders WHERE o_orderkey % 3 <> 0"""


def queries() -> dict:
    return {n: f for n, f in sorted(globals().items()) if n[0] == "q" and n[1:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
