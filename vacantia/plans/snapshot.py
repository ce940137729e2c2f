"""Daily snapshot plan: guards, diff, verification and counts of one day, with events written before state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import BOARD, KEY, degraded, diff, guard_day, last_wins, verify_removals

#: Columns of a snapshot row.
OBSERVED = "provider string, company string, job_id string, t string, loc string, dept string, remote boolean, url string, posted string, updated string"
STATE = OBSERVED + ", h string, first_seen string, last_seen string, posted_src string, omitted int, unverified int"


def job_rows(jobs: DataFrame) -> DataFrame:
    """Job rows as snapshot rows; without an id of any kind they are dropped; dates are cut to days."""
    day = lambda c: F.when(F.length(F.coalesce(c, F.lit(""))) > 0, F.substring(c, 1, 10))
    rows = jobs.select("provider", F.col("companySlug").alias("company"), F.coalesce("sourceId", "id").alias("job_id"), F.col("title").alias("t"), F.col("locationRaw").alias("loc"), F.col("department").alias("dept"), "remote", "url", day("postedAt").alias("posted"), day("updatedAt").alias("updated"), "ord")
    return last_wins(rows.where("job_id is not null and job_id <> ''"), KEY, "ord").drop("ord")


def snapshot_day(state: DataFrame, companies: DataFrame, boards: DataFrame, observed: DataFrame, verdicts: DataFrame, today: str) -> dict[str, DataFrame]:
    """state, companies, events and counts after a day.

    ``boards`` (BOARD, fetch_status, jobs) are the day's fetches and ``observed`` their postings. Only boards that the guards let through are
    diffed; others keep their state and get neither events nor a counts row. ``counts.open`` is the size of the state after verification.
    """
    bad = degraded(boards.where("fetch_status = 'ok'"), "provider", "jobs").where("degraded").select("provider")
    sizes = state.groupBy(*BOARD).agg(F.count("*").alias("open"))
    known = companies.drop("open").join(sizes, BOARD, "left")
    judged = guard_day(boards, known, bad)
    through = judged.where("action = 'diff'").select(*BOARD)
    before = state.join(through, BOARD, "left_semi")
    new_state, events = diff(before, observed.join(through, BOARD, "left_semi"), today)
    events, new_state = verify_removals(events, new_state, before, verdicts)
    whole = new_state.unionByName(state.join(through, BOARD, "left_anti"), allowMissingColumns=True)
    counts = through.join(new_state.groupBy(*BOARD).agg(F.count("*").alias("open")), BOARD, "left").na.fill(0, ["open"]).withColumn("d", F.lit(today))
    # a board stays suspect while postings that the feed lacks are still held open
    held = new_state.where("omitted > 0 or unverified > 0").select(*BOARD).distinct().withColumn("held", F.lit(True))
    empty = judged.join(held, BOARD, "left").withColumn("status", F.when((F.col("action") == "diff") & (F.col("jobs") == 0) & F.col("held"), "empty_suspect").otherwise(F.col("status")))
    after = empty.select(*BOARD, "status", "consecutive_failures", "stale", F.coalesce("held", F.lit(False)).alias("held"))
    tracked = companies.select(*BOARD, "tracked_since").join(after.drop("held"), BOARD, "full_outer").withColumn("tracked_since", F.coalesce("tracked_since", F.lit(today)))
    return {"state": whole, "companies": tracked, "events": events, "counts": counts}
