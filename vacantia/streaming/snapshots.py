"""Structured Streaming over landed snapshots: daily history by micro-batch, and windowed event counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import BOARD, KEY, diff, last_wins
from ..plans.snapshot import STATE


def windowed_counts(events: DataFrame, time_col: str = "ts", kind_col: str = "event_type", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts of event kinds in time windows; events later than the watermark are left out."""
    return events.withWatermark(time_col, late).groupBy(F.window(time_col, window).alias("w"), kind_col).agg(F.count("*").alias("n")).select("w.start", "w.end", kind_col, "n")


def history_sink(spark: SparkSession, root: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that folds landed snapshot rows (with day d, and ord if rows of a posting may repeat) into events and state below ``root``.

    Only the boards that a batch has of a day are compared, and only where the state doesn't know a later day or that day of them: others keep their postings, and
    late days change nothing. Of a posting's rows the last by ord counts, without ord any one. Events are written before the state, by day and batch, so that a
    batch that is run again after a failure replaces what it wrote and nothing else. The state of a batch is a folder of its own; the newest complete one counts.
    """

    def newest(before: int) -> DataFrame:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for k in range(before - 1, -1, -1):
            path = jvm.org.apache.hadoop.fs.Path(f"{root}/state/{k}/_SUCCESS")
            if path.getFileSystem(conf).exists(path):
                return spark.read.schema(STATE).parquet(f"{root}/state/{k}")
        return spark.createDataFrame([], STATE)

    def fold(batch: DataFrame, number: int) -> None:
        state = newest(number)
        days = [r[0] for r in batch.select("d").distinct().orderBy("d").collect()]  # the days of one micro-batch
        for day in days:
            rows = batch.where(F.col("d") == day).drop("d")
            rows = last_wins(rows, KEY, "ord").drop("ord") if "ord" in rows.columns else rows.dropDuplicates(KEY)
            known = state.groupBy(*BOARD).agg(F.max("last_seen").alias("newest")).where(F.col("newest") >= day)
            through = rows.select(*BOARD).distinct().join(known, BOARD, "left_anti")
            after, events = diff(state.join(through, BOARD, "left_semi"), rows.join(through, BOARD, "left_semi"), day)
            events.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d", "batch").parquet(f"{root}/events")
            zero = F.lit(0)
            whole = after.unionByName(state.join(through, BOARD, "left_anti"), allowMissingColumns=True)
            whole.select(*[c for c in state.columns if c not in ("omitted", "unverified")], zero.alias("omitted"), zero.alias("unverified")).write.mode("overwrite").parquet(f"{root}/folding/{number}/{day}")
            state = spark.read.schema(STATE).parquet(f"{root}/folding/{number}/{day}")
        state.write.mode("overwrite").parquet(f"{root}/state/{number}")
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/folding/{number}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    return fold
