"""Stateful and relational operators, plans and streaming."""

import json
import zlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from vacantia.operators import history, lifecycle, rows
from vacantia.plans import directory, export, snapshot
from vacantia.plans.ingest import Options, ingest
from vacantia.schema import COMPACT, MINIMAL, RAW_BOARDS, to_profile
from vacantia.sources.providers import departments_by_job, rippling
from vacantia.streaming.snapshots import history_sink, windowed_counts

OBS = snapshot.OBSERVED


def job(i, t="Dev", loc="Berlin", dept="Eng", remote=None, posted=None, c="acme", p="lever"):
    return (p, c, i, t, loc, dept, remote, None, posted, None)


def days(spark, *snapshots):
    """State and events after successive days' postings."""
    state, out = spark.createDataFrame([], snapshot.STATE), {}
    for n, jobs in enumerate(snapshots, 1):
        today = f"2026-01-0{n}"
        state, events = history.diff(state, spark.createDataFrame(jobs, OBS), today)
        state = state.withColumns({"omitted": F.lit(0), "unverified": F.lit(0)})
        state = spark.createDataFrame(state.collect(), state.schema)
        out[today] = sorted((r["ev"], r["job_id"], r["changed"], r["days_open"]) for r in events.collect())
    return state, out


def test_diff_rules(spark):
    _, ev = days(spark, [job("1", posted="2025-12-01T00"), job("2"), job("4", dept=None)], [job("1", loc=" BERLIN "), job("3", t="Ops"), job("4")], [job("1", loc="Bonn", dept=None), job("9", t="ops"), job("4", dept="X")])
    assert [e[:2] for e in ev["2026-01-01"]] == [("added", "1"), ("added", "2"), ("added", "4")]
    assert ev["2026-01-02"] == [("added", "3", None, None), ("removed", "2", None, 1)]
    assert ev["2026-01-03"] == [("added", "9", None, None), ("changed", "1", ["loc"], None), ("changed", "4", ["dept"], None), ("removed", "3", None, None)]


def test_diff_state(spark):
    state, _ = days(spark, [job("1", posted="2025-12-01T00")], [job("1", dept=None, t="New")])
    r = state.first()
    assert (r["dept"], r["first_seen"], r["last_seen"], r["posted"], r["posted_src"]) == ("Eng", "2026-01-01", "2026-01-02", "2025-12-01", "api")


def test_reposts_with_unknown_departments(spark):
    schema = "provider string, company string, job_id string, ev string, t string, loc string, dept string, remote boolean, days_open int"
    e = [("p", "c", "a", "removed", "T", "L", None, True, 5), ("p", "c", "b", "added", "t", "l", "X", True, None), ("p", "c", "d", "removed", "T", "L", "Y", True, 5), ("p", "c", "e", "removed", "T", "L", "x", True, 5), ("p", "d", "f", "removed", "T", "L", "X", True, 5)]
    got = {r["job_id"]: r["days_open"] for r in history.suppress_reposts(spark.createDataFrame(e, schema)).collect()}
    assert got == {"a": None, "b": None, "d": 5, "e": None, "f": 5}


def test_verification(spark):
    prev, _ = days(spark, [job(str(k)) for k in range(5)])
    prev = prev.withColumn("unverified", F.when(F.col("job_id") == "3", 2).otherwise(0))
    state, events = history.diff(prev, spark.createDataFrame([job("0")], OBS), "2026-01-02")
    verdicts = spark.createDataFrame([("lever", "acme", "1", "gone"), ("lever", "acme", "2", "live"), ("lever", "acme", "3", "unknown"), ("lever", "acme", "4", "unknown")], "provider string, company string, job_id string, verdict string")
    out, after = history.verify_removals(events, state, prev, verdicts)
    assert {(r["job_id"], r["verified"]) for r in out.collect()} == {("1", True), ("3", False)}
    assert {(r["job_id"], r["omitted"], r["unverified"]) for r in after.collect()} == {("0", 0, 0), ("2", 1, 0), ("4", 0, 1)}


def test_snapshot_day_guards(spark):
    state, _ = days(spark, [job("1"), job("2", c="gone"), job("3", c="failing")])
    companies = spark.createDataFrame([("lever", c, "ok", 0, False, "2026-01-01", 1) for c in ("acme", "gone", "failing")], "provider string, company string, status string, consecutive_failures int, stale boolean, tracked_since string, open int")
    boards = spark.createDataFrame([("lever", "acme", "ok", 1), ("lever", "gone", "ok", 0), ("lever", "failing", "timeout", 0)], "provider string, company string, fetch_status string, jobs int")
    none = spark.createDataFrame([], "provider string, company string, job_id string, verdict string")
    one = snapshot.snapshot_day(state, companies, boards, spark.createDataFrame([job("1")], OBS), none, "2026-01-02")
    assert one["events"].count() == 0 and {r["company"] for r in one["counts"].collect()} == {"acme"} and one["state"].count() == 3
    status = {r["company"]: (r["status"], r["consecutive_failures"]) for r in one["companies"].collect()}
    assert status == {"acme": ("ok", 0), "gone": ("empty_suspect", 0), "failing": ("ok", 1)}
    again = one["companies"].withColumn("open", F.lit(1))
    two = snapshot.snapshot_day(one["state"], again, boards, spark.createDataFrame([job("1")], OBS), none, "2026-01-03")
    assert [(r["ev"], r["company"]) for r in two["events"].collect()] == [("removed", "gone")]


def test_buckets(spark):
    df = spark.createDataFrame([("greenhouse", "anthropic"), ("lever", "Ünï")], "p string, c string").select(history.bucket_of("p", "c").alias("b"), "p", "c")
    assert all(r["b"] == zlib.crc32(f"{r['p']}:{r['c']}".encode()) % 64 for r in df.collect()) and df.first()["b"] == 57
    assert [spark.range(1).select(history.shard_of(F.lit(b), 32)).first()[0] for b in (0, 1, 63)] == [0, 0, 31]


def test_prune_with_bad_day(spark):
    df = spark.createDataFrame([("2020-01-01",)], "d string")
    assert history.prune(df, "junk").count() == 1 and history.prune(df, "2026-01-01").count() == 0


def test_filters(spark):
    schema = "title string, locationRaw string, city string, region string, country string, countryCode string, locations array<struct<raw:string,city:string,region:string,country:string,countryCode:string>>, remote boolean, department string, team string, employmentType string, employmentTypeSource string, postedAt string"
    df = spark.createDataFrame([("Dev", "Berlin", "Berlin", None, "Germany", "DE", None, True, "Eng", None, None, None, None), (None, "x", None, None, None, None, [("y", None, None, None, "FR")], None, None, "eng", "contract", "title", "2020-01-01T00:00:00Z")], schema)
    n = lambda **k: df.where(rows.Filters(**k).predicate()).count()
    assert (n(), n(title_include=["DEV"]), n(title_exclude=["dev"]), n(locations=["de"]), n(locations=["germ"]), n(locations=["fr"]), n(remote_only=True)) == (2, 1, 1, 1, 1, 1, 1)
    assert (n(departments=["eng"]), n(employment_types=["full_time"]), n(employment_types=["contract"], strict_employment=True), n(posted_after=datetime(2024, 1, 1, tzinfo=timezone.utc))) == (2, 1, 0, 1)
    now = datetime(2026, 1, 10, tzinfo=timezone.utc)
    assert rows.parse_cutoff("3 days ago", now).day == 7 and rows.parse_cutoff("soon", now) is None and rows.parse_cutoff("2026-01-01", now).day == 1 and rows.parse_cutoff("99999999999 years", now).year == 1970


def test_dedupe_is_order_invariant(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else str(i % 5), i % 3) for i in range(60)], "ord int, id string, k int")
    a, b = (sorted(map(tuple, rows.dedupe_first(x, "id", ["ord"]).collect()), key=str) for x in (df, df.repartition(7).orderBy(F.rand(1))))
    assert a == b and len(a) == 9 + 5
    kept = rows.dedupe_content(df.where("id is not null").withColumn("key", F.when(F.col("k") > 0, F.col("k").cast("string"))), "ord", "key", ["ord"])
    assert {r["ord"]: len(r["dedupedFrom"] or []) for r in kept.where("key is not null").collect()} == {1: 16, 2: 16}


def test_seen_state(spark):
    seen = spark.createDataFrame([("a", "2026-01-01T00:00:00Z", None, "h"), ("b", "2026-01-01T00:00:00Z", "2026-01-09T00:00:00Z", "h")], "id string, firstSeen string, lastSeen string, changeHash string")
    now = datetime(2026, 1, 10, tzinfo=timezone.utc)
    assert [r["id"] for r in rows.prune_seen(seen, now, 5).collect()] == ["b"] and rows.prune_seen(seen, now, 0).count() == 2
    after = {r["id"]: (r["firstSeen"][:10], r["changeHash"]) for r in rows.upsert_seen(seen, spark.createDataFrame([("a", "n"), ("c", "n")], "id string, changeHash string"), "2026-01-10").collect()}
    assert after == {"a": ("2026-01-01", "n"), "b": ("2026-01-01", "h"), "c": ("2026-01-10", "n")}


def test_index_checks(spark):
    twice = spark.createDataFrame([("p", "c", "2026-01-01", [("1", None, None)])] * 2, "p string, c string, t string, j array<struct<job_id:string,posted:string,first_seen:string>>")
    with pytest.raises(ValueError, match="twice"):
        lifecycle.flatten_index(twice)
    for bad in (None, "junk", "2026-01-01"):
        with pytest.raises(ValueError, match="index"):
            lifecycle.check_age(bad, "2026-01-04")
    lifecycle.check_age("2026-01-02T00", "2026-01-04")


def boards(spark):
    post = {"id": 1, "title": "Engineer (Remote)", "company_name": "Acme", "departments": [{"name": "1234 Eng"}], "offices": [{"location": "Berlin, Germany"}], "location": {"name": "Hybrid"}, "absolute_url": "u", "first_published": "2026-08-01T00:00:00Z", "content": "&lt;p&gt;a@b.com $120k - $150k&lt;/p&gt;"}
    feed = "<workzag-jobs><position><id>7</id><name>P</name><office>Munich</office><employmentType>permanent</employmentType><schedule>part-time</schedule></position></workzag-jobs>"
    return spark.createDataFrame(
        [
            ("greenhouse", "acme", "i", "ok", json.dumps({"jobs": [post, {}, {**post, "id": 2, "location": 5}, {**post, "id": 1}]}), 0),
            ("rippling", "rp", "i", "ok", json.dumps([{"uuid": "u1", "name": "N", "workLocation": {"label": "Paris, France"}}, {"uuid": "u1", "name": "N", "workLocation": {"label": "Berlin, Germany"}}]), 1),
            ("personio", "ps", "i", "ok", feed, 2), ("lever", "bad", "i", "ok", "{}", 3), ("recruitee", "no", "i", "ok", '{"error": "gone"}', 4), ("other", "x", "i", "ok", "[]", 5), ("lever", "nil", "i", "ok", None, 6),
        ],
        RAW_BOARDS,
    )


def test_ingest(spark):
    out = ingest(boards(spark), Options("2026-09-01T00:00:00Z", include_description=True))
    got = {r["id"]: r for r in out["jobs"].collect() if r["id"]}
    assert set(got) == {"greenhouse:acme:1", "greenhouse:acme:2", "rippling:rp:u1", "personio:ps:7"}
    g = got["greenhouse:acme:1"]
    assert (g["city"], g["workplaceType"], g["salaryMax"], g["department"], g["descriptionText"], g["titleNormalized"]) == ("Berlin", "hybrid", 150000, "Eng", "[redacted] $120k - $150k", "engineer")
    assert got["personio:ps:7"]["employmentType"] == "part_time" and len(got["rippling:rp:u1"]["locations"]) == 2
    assert {(r["slug"], r["status"]) for r in out["errors"].collect()} == {("bad", "parse_error"), ("no", "not_found"), ("x", "provider_unavailable"), ("nil", "parse_error")}
    assert {r["slug"]: (r["jobsFound"], r["jobsKept"]) for r in out["summaries"].collect()}["acme"] == (4, 3)
    assert to_profile(out["jobs"], "minimal").columns == MINIMAL and to_profile(out["jobs"], "compact").columns == COMPACT


def test_ingest_delta_and_limits(spark):
    seen = spark.createDataFrame([("greenhouse:acme:1", "2026-01-01", "2026-01-01", "h")], "id string, firstSeen string, lastSeen string, changeHash string")
    out = ingest(boards(spark), Options("2026-09-01T00:00:00Z", only_new=True, max_jobs_per_company=1, max_jobs=2), seen)
    assert [r["id"] for r in out["jobs"].orderBy("ord").collect()] == ["greenhouse:acme:2", "rippling:rp:u1"]
    assert {r["id"] for r in out["seen"].collect()} == {"greenhouse:acme:1", "greenhouse:acme:2", "rippling:rp:u1"}
    assert ingest(boards(spark), Options("2026-09-01T00:00:00Z", only_new=True))["jobs"].count() == 0


def test_details_override_and_fail(spark):
    b = boards(spark).where("provider = 'rippling'")
    detail = lambda body: spark.createDataFrame([("rippling", "rp", "u1", body)], "provider string, slug string, uuid string, body string")
    assert rippling(b, detail('{"name": "Detailed"}')).first()["title"] == "Detailed"
    failed = rippling(b, detail(None)).first()
    assert failed["title"] == "N" and failed["warnings"] == ["detail_failed"]


def test_department_tree(spark):
    tree = {"departments": [{"id": 1, "name": "All", "child_ids": [2], "jobs": [{"id": "a"}, {"id": "b"}]}, {"id": 2, "name": "Eng", "child_ids": [], "jobs": [{"id": "a"}]}]}
    df = spark.createDataFrame([("greenhouse", "acme", json.dumps(tree))], "provider string, slug string, body string")
    assert {r["job_id"]: r["departments"] for r in departments_by_job(df).collect()} == {"a": "Eng", "b": "All"}


def test_export(spark, tmp_path):
    counts = spark.createDataFrame([("2026-01-01", "lever", "a", 2), ("2026-01-02", "lever", "a", 1), ("2026-01-02", "personio", "b", 1), ("2026-01-02", "lever", "c", 0)], "d string, provider string, company string, open int")
    events = spark.createDataFrame([("2026-01-02", "lever", "a", "1", "removed", True), ("2026-01-02", "lever", "c", "2", "removed", None), ("2026-01-01", "lever", "a", "3", "added", None)], "d string, provider string, company string, job_id string, ev string, verified boolean")
    none = spark.createDataFrame([], "provider string, company string")
    t = export.tiers(counts, events, none)
    assert [tuple(r) for r in t["sample"].collect()] == [("2026-01-01", "lever", "a", 2, None, 0), ("2026-01-02", "lever", "a", 1, 0, 1)]
    assert t["daily"].count() == 3 and t["events"].count() == 2
    report = {(r["by"], r["value"]): r["n"] for r in export.coverage(events, spark.createDataFrame([("2026-01-01",), (None,)], "tracked_since string")).collect()}
    assert report[("verified", "true")] == 1 and report[("verified", "null")] == 1 and report[("event", "removed")] == 2 and report[("tracked_since", "unknown")] == 1
    out = f"file://{tmp_path}"
    export.write_archive(events, f"{out}/archive")
    assert spark.read.json(f"{out}/archive").count() == 3
    pair = [(t["sample"], "csv", f"{out}/s"), (t["sample"], "json", f"{out}/j")]
    export.replace_pair(spark, pair)
    with pytest.raises(ValueError, match="nothing"):
        export.replace_pair(spark, [(t["sample"].limit(0), "csv", f"{out}/s"), pair[1]])
    assert spark.read.csv(f"{out}/s", header=True).count() == 2
    with pytest.raises(ValueError, match="unexpected"):
        export.csv_ready(events, ("d",))


def test_directory(spark):
    urls = spark.createDataFrame([("https://jobs.lever.co/Acme", 0), ("https://jobs.eu.lever.co/acme/x", 1), ("https://jobs.ashbyhq.com/b", 2), ("nothing", 3)], "url string, ord int")
    merged = directory.merge_candidates([directory.candidates(urls.where("ord = 0"), "url", 0), directory.candidates(urls.where("ord > 0"), "url", 1)])
    assert {(r["provider"], r["slug"], r["region"]) for r in merged.collect()} == {("lever", "Acme", "eu"), ("ashby", "b", None)}
    probes = directory.probe(spark.createDataFrame([("lever", "Acme", "ok", 3, "Acme Inc"), ("ashby", "b", "not_found", None, None)], "provider string, slug string, status string, job_count int, name string"))
    empty = spark.createDataFrame([], "key string, provider string, slug string, site string, region string, name string, name_norm string, domain string, status string, job_count bigint, first_seen string, checked_at string, dead_since string")
    one = directory.build(empty, merged, probes, "2026-01-01")
    two = directory.build(one, merged.where("provider = 'lever'"), probes, "2026-01-05")
    got = {r["slug"]: (r["status"], r["first_seen"], r["checked_at"], r["dead_since"]) for r in two.collect()}
    assert got == {"Acme": ("ok", "2026-01-01", "2026-01-05", None), "b": ("dead", "2026-01-01", "2026-01-01", "2026-01-01")}
    lines = spark.createDataFrame([("Lever:Acme # out",), ("# none",), ("",)], "value string")
    blocked = directory.read_blocklist(lines)
    assert [tuple(r) for r in blocked.collect()] == [("lever", "Acme")] and directory.public(two, blocked).count() == 0
    watch = spark.createDataFrame([("ashby", "z", None, "2025", "manual")], "provider string, company string, site string, added string, source string")
    assert directory.expand_watchlist(watch, two, "2026-01-06").count() == 2


def test_streaming(spark, tmp_path):
    fold = history_sink(spark, f"file://{tmp_path}/h")
    day = lambda jobs, d: spark.createDataFrame(jobs, OBS).withColumn("d", F.lit(d))
    fold(day([job("1"), job("2")], "2026-01-01"), 0)
    fold(day([job("1")], "2026-01-02"), 1)
    fold(day([job("1")], "2026-01-02"), 1)  # again
    fold(day([job("9", c="other"), job("9", c="other")], "2026-01-03"), 2)  # another board alone, a row twice
    fold(day([job("1"), job("2"), job("3")], "2026-01-01"), 3)  # late
    got = spark.read.parquet(f"file://{tmp_path}/h/events").groupBy("ev").count().collect()
    assert {r["ev"]: r["count"] for r in got} == {"added": 3, "removed": 1}
    assert sorted(r["job_id"] for r in spark.read.parquet(f"file://{tmp_path}/h/state/3").collect()) == ["1", "9"]
    src = f"{tmp_path}/in"
    spark.createDataFrame([(datetime(2026, 1, 1, h), "a") for h in range(5)], "ts timestamp, event_type string").write.parquet(src)
    stream = windowed_counts(spark.readStream.schema("ts timestamp, event_type string").parquet(src))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("vacantia_w").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("vacantia_w").first()["n"] == 5
