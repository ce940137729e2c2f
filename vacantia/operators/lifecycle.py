"""Lifecycle enrichment: how long a posting has been open, by two lookups in the age index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_between

CHARGEABLE = ("board", "observed")


def flatten_index(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(boards, jobs) of an age index with p, c, t and j; fails where a board is there twice."""
    twice = index.groupBy("p", "c").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the index has {twice[0][0]}:{twice[0][1]} twice")
    boards = index.select(F.col("p").alias("provider"), F.col("c").alias("company"), F.col("t").alias("tracked_since"))
    jobs = index.select(F.col("p").alias("provider"), F.col("c").alias("company"), F.explode("j").alias("j")).select("provider", "company", "j.job_id", "j.posted", "j.first_seen")
    return boards, jobs


def check_age(generated: str | None, today: str, most: int = 2) -> None:
    """Fail on an index that is undated or older than ``most`` days."""
    from datetime import date

    try:
        age = (date.fromisoformat(today) - date.fromisoformat((generated or "")[:10])).days
    except ValueError:
        raise ValueError("the index has no date") from None
    if age > most:
        raise ValueError(f"the index is {age} days old")


def enrich(rows: DataFrame, boards: DataFrame, jobs: DataFrame, today: str, order: str) -> DataFrame:
    """Rows (with provider, company, job_id, unsupported, from their URL) and coverage, ageDays, ageBasis, posted, first_seen, firstSeenCensored, stillListed, tracked_since, historyWindowDays, duplicateOf, chargeable.

    The ladder: no identity (unsupported or unresolved), board not watched, posting not known, tracked. The age is the board's own date; else
    the first day we saw it, which is only a floor if that was the day we began to watch. Later rows of a posting
    are kept, point to the first by ``order``, and are never charged.
    """
    r = rows.join(boards.withColumn("watched", F.lit(True)), ["provider", "company"], "left").join(jobs.withColumn("known", F.lit(True)), ["provider", "company", "job_id"], "left")
    coverage = (
        F.when(F.col("job_id").isNull(), F.when(F.col("unsupported").isNotNull(), "unsupported_provider").otherwise("unresolved_url"))
        .when(F.col("watched").isNull(), "board_untracked").when(F.col("known").isNull(), "job_unknown").otherwise("tracked")
    )
    tracked = F.col("coverage") == "tracked"
    dated = F.length(F.coalesce("posted", F.lit(""))) > 0
    sighted = F.length(F.coalesce("first_seen", F.lit(""))) > 0
    r = r.withColumn("coverage", coverage).withColumn("firstSeenCensored", F.when(tracked, F.coalesce(sighted & (F.col("first_seen") <= F.col("tracked_since")), F.lit(False))))
    basis = F.when(tracked & dated, "board").when(tracked & sighted, F.when(F.col("firstSeenCensored"), "observed_floor").otherwise("observed"))
    age = F.when(dated, days_between("posted", F.lit(today))).otherwise(days_between("first_seen", F.lit(today)))
    r = r.withColumn("ageBasis", basis).withColumn("ageDays", F.when(tracked, age)).withColumn("stillListed", F.when(tracked, True)).withColumn("historyWindowDays", days_between("tracked_since", F.lit(today)))
    first = F.first("url").over(Window.partitionBy("provider", "company", "job_id").orderBy(order))
    nth = F.row_number().over(Window.partitionBy("provider", "company", "job_id").orderBy(order))
    r = r.withColumn("duplicateOf", F.when(F.col("job_id").isNotNull() & (nth > 1), first))
    return r.withColumn("chargeable", is_chargeable() & F.col("duplicateOf").isNull())


def is_chargeable() -> Column:
    """A tracked posting with an age that is no mere bound."""
    return (F.col("coverage") == "tracked") & F.col("ageDays").isNotNull() & F.coalesce(F.col("ageBasis").isin(*CHARGEABLE), F.lit(False))
