"""A run's shell and the stored state it reads and writes."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from vacantia.plans import run
from vacantia.sources import stores


def test_companies_of_an_input():
    assert run.read_companies({"startUrls": [{"url": " https://a.b "}, {"value": "x"}, {"slug": "x"}, {}, 5, ""]}) == ["https://a.b", "x"]
    assert run.read_companies({"companies": "acme"}) == ["acme"] and run.read_companies({"companies": {"a": 1}}) == [] and run.read_companies({}) == []
    assert len(run.read_companies({"companies": [f"c{k}" for k in range(5000)]})) == 2000


def test_numbers_of_an_input():
    defaults = dict.fromkeys(run.BOUNDS, 10)
    got = run.read_numbers({"maxJobs": 0, "maxConcurrency": "lots", "requestTimeoutSecs": 0, "maxJobsPerCompany": -5, "stateRetentionDays": float("inf")}, defaults)
    assert got == {"maxJobs": 0, "maxConcurrency": 10, "requestTimeoutSecs": 5, "maxJobsPerCompany": 0, "stateRetentionDays": 10}
    assert run.read_shard({"shard": 3, "shardCount": 32}) == (3, 32) and run.read_shard({}) == (0, 4)
    for bad in ({"shardCount": 65}, {"shard": 4}, {"shard": -1, "shardCount": 2}):
        with pytest.raises(ValueError):
            run.read_shard(bad)


def test_entries_resolve(spark):
    schema = stores.DIRECTORY
    row = lambda p, s, n, d, st="ok": (p, s, None, None, n, n and n.lower(), d, st, 3, None, None, None)
    directory = spark.createDataFrame([row("lever", "Acme", "Acme", "acme.com"), row("ashby", "acme-2", "Acme", None), row("ashby", "solo", "Solo Co", "www.solo.io"), row("ashby", "bad slug", "Bad", None), row("ashby", "gone", "Gone", None, "dead")], schema)
    entries = ["acme", "SOLO", "solo co", "https://www.solo.io/careers", "none.example.org", "lever:x", "bad", "gone", "  ", "https://jobs.ashbyhq.com/y"]
    frame = spark.createDataFrame([(e, k) for k, e in enumerate(entries)], "entry string, ord int")
    got = {r["entry"]: r for r in run.resolve(frame, directory).collect()}
    assert {e: got[e]["status"] for e in entries} == {
        "acme": "unconfirmed", "SOLO": "ok", "solo co": "ok", "https://www.solo.io/careers": "ok", "none.example.org": "unresolved_domain", "lever:x": "ok", "bad": "not_found", "gone": "not_found", "  ": "not_found", "https://jobs.ashbyhq.com/y": "ok",
    }
    assert got["acme"]["candidates"] == ["lever:Acme", "ashby:acme-2"] and got["SOLO"]["ref"]["slug"] == "solo"
    pinned = {r["entry"]: (r["status"], r["ref"] and r["ref"]["slug"]) for r in run.resolve(frame, directory, ["ashby"], "ashby").collect()}
    assert pinned["acme"] == ("ok", "acme") and pinned["lever:x"] == ("not_found", None) and pinned["https://jobs.ashbyhq.com/y"] == ("ok", "y")
    boards, errors = run.resolve_all(frame, None, "2026-01-01T00:00:00Z")
    assert {r["input"] for r in boards.collect()} == {"lever:x", "https://jobs.ashbyhq.com/y"}
    assert errors.columns == list(run.ERROR_COLUMNS) and errors.count() == 7  # blank entries are dropped


def test_delivery_stops(spark):
    jobs = spark.createDataFrame([(0, k, f"i{k}") for k in range(10)], "ord int, row int, id string")
    assert [(run.deliver(jobs, *a)[0].count(), run.deliver(jobs, *a)[1]) for a in ((), (3,), (0, 4), (5, 5), (50,))] == [(10, None), (3, "max_jobs_reached"), (4, "budget_exhausted"), (5, "budget_exhausted"), (10, None)]
    assert run.remaining(0, 5) is None and run.remaining(5, 7) == 0
    assert run.should_fail("run_deadline", 0, 0) and run.should_fail(None, 100, 6) and not run.should_fail(None, 100, 5) and not run.should_fail("max_jobs", 0, 0)
    assert run.Budget(0.05).over(seconds=3600) and not run.Budget(0.2).over(seconds=3600, jobs=10)


def test_verdicts_beyond_the_cap_are_unknown(spark):
    asked = spark.createDataFrame([("p", "c", str(k)) for k in range(6)], "provider string, company string, job_id string")
    landed = spark.createDataFrame([("p", "c", "0", "gone"), ("p", "c", "1", "live"), ("p", "c", "5", "gone"), ("p", "c", "2", "odd")], "provider string, company string, job_id string, verdict string")
    got = {r["job_id"]: r["verdict"] for r in run.ask_verdicts(asked, landed, 4, ["job_id"]).collect()}
    assert got == {"0": "gone", "1": "live", "2": "unknown", "3": "unknown", "4": "unknown", "5": "unknown"}


def test_board_memory(spark):
    seen = spark.createDataFrame([("p", "a", "2025-01-01", "2025-02-01", 3), ("p", "b", "2025-01-01", "2025-02-01", 4)], "provider string, companySlug string, firstSeen string, lastSeen string, jobs long")
    found = spark.createDataFrame([("p", "c")], "provider string, companySlug string")
    boards = spark.createDataFrame([("p", "a"), ("p", "c")], "provider string, slug string")
    got = sorted(tuple(r) for r in run.board_memory(seen, found, boards, "2026-01-01").collect())
    assert got == [("p", "a", "2025-01-01", "2026-01-01", 0), ("p", "b", "2025-01-01", "2025-02-01", 4), ("p", "c", "2026-01-01", "2026-01-01", 1)]


def test_directory_round_trip(spark, tmp_path):
    good = {"provider": "lever", "slug": "Acme", "job_count": 3, "status": "ok"}
    lines = [json.dumps(good), "not json", '{"provider":"x"}', '{"provider":"lever","slug":"b"', "[1]"]
    (tmp_path / "companies.jsonl.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    (tmp_path / "empty.jsonl").write_text("")
    rows = stores.read_directory(spark, f"file://{tmp_path}/none.jsonl", f"file://{tmp_path}/empty.jsonl", f"file://{tmp_path}/companies.jsonl.gz")
    assert [(r["provider"], r["slug"], r["job_count"]) for r in rows.collect()] == [("lever", "Acme", 3)]
    assert stores.read_directory(spark, f"file://{tmp_path}/none.jsonl").count() == 0
    stores.write_directory(rows.withColumn("key", F.lower("slug")), f"file://{tmp_path}/out")
    assert stores.read_directory(spark, f"file://{tmp_path}/out").first()["slug"] == "Acme"


def test_history_store(spark, tmp_path):
    store = stores.HistoryStore(spark, f"file://{tmp_path}/h")
    schema = "job_id string"
    assert store.get("events", schema).count() == 0 and store.days() == []
    put = lambda day, shard, *ids: store.put("events", spark.createDataFrame([(i, day, shard) for i in ids], "job_id string, d string, shard int"))
    put("2026-01-01", 0, "a", "b"), put("2026-01-01", 1, "c"), put("2026-01-02", 0, "d"), put("2026-01-01", 0, "e")
    assert sorted(r["job_id"] for r in store.get("events", schema).collect()) == ["c", "d", "e"]
    assert [r["job_id"] for r in store.get("events", schema, since="2026-01-02").collect()] == ["d"] and store.days() == ["2026-01-01", "2026-01-02"]
    assert "PartitionFilters: [isnotnull(d" in store.get("events", schema, since="2026-01-02")._jdf.queryExecution().toString()
    done = spark.createDataFrame([(0, "2026-01-02"), (1, "2026-01-01")], "bucket int, as_of string")
    assert store.open_buckets(done, 0, "2026-01-02")[:2] == [1, 2] and store.open_buckets(done, 0, "2026-01-02", force=True)[0] == 0
    assert sum((stores.buckets_for_shard(k, 5) for k in range(5)), []) == list(range(64))


def test_keys_and_values(spark):
    keys = [stores.state_key(7), stores.day_key("events", "2026-01-01", 3), "other"]
    got = spark.createDataFrame([(k,) for k in keys], "key string").select(*[c.alias(n) for c, n in zip(stores.parse_key(F.col("key")), ("kind", "bucket", "d", "shard"), strict=True)]).collect()
    assert [tuple(r) for r in got] == [("state", 7, None, None), ("events", None, "2026-01-01", 3), (None, None, None, None)]
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, None)], "key string, id long, t string")
    coded = stores.encode_values(rows, "key", ["id"], ["id", "t"])
    assert coded.first()["value"] == '{"id":1,"t":null}\n{"id":2,"t":"b"}'
    quoted = coded.unionByName(spark.createDataFrame([("q", json.dumps('{"id":3,"t":"x"}\n{"id":')), ("bad", '"open'), ("n", None)], "key string, value string"))
    assert sorted((r["key"], r["id"]) for r in stores.decode_values(quoted, "id bigint, t string").collect()) == [("k", 1), ("k", 2), ("q", 3)]


def test_seen_state_and_age_index(spark, tmp_path):
    path = f"file://{tmp_path}/seen"
    assert stores.open_seen(spark, path).count() == 0
    assert stores.save_seen(spark.createDataFrame([("a", "d", "d", "h"), ("", "d", "d", "h")], stores.SEEN), path) and stores.open_seen(spark, path).count() == 1
    index = {"schema": 1, "generated": "2026-01-02T00:00:00Z", "boards": [{"board": "lever:a", "jobs": [["1", "x", "y"]]}]}

    def read(**changes):
        (tmp_path / "index.json").write_text(json.dumps({**index, **changes}))
        return stores.read_age_index(spark, f"file://{tmp_path}/index.json", "2026-01-04").collect()

    assert [tuple(r) for r in read()] == [("lever:a", "1", "x", "y")]
    for bad in ({"schema": 2}, {"generated": "2026-01-01"}, {"generated": None}, {"boards": index["boards"] * 2}, {"boards": [{"board": "b", "jobs": [["1"]]}]}):
        with pytest.raises(ValueError):
            read(**bad)
