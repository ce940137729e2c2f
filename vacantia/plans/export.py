"""Export plan: tiers of closures, tables replaced as a whole, and the bundle with its coverage report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import closure_summary, publishable, recent_days, trustworthy_events

# Columns of the free tier, and the provider it leaves out.
FREE_COLUMNS = ("d", "provider", "company", "open", "added", "removed")
FREE_WITHOUT = ("personio",)


def tiers(counts: DataFrame, events: DataFrame, blocklist: DataFrame, all_counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """sample (free: six columns, the last three days), daily and events (paid)."""
    summary = closure_summary(counts, events, all_counts)
    return {
        "sample": recent_days(publishable(summary, blocklist, FREE_WITHOUT), 3).select(*FREE_COLUMNS).orderBy(*FREE_COLUMNS[:3]),
        "daily": publishable(summary, blocklist).orderBy(*FREE_COLUMNS[:3]),
        "events": publishable(trustworthy_events(counts, events), blocklist),
    }


def coverage(events: DataFrame, companies: DataFrame) -> DataFrame:
    """Counts by provider, event, day and verification, in one scan with grouping sets, and boards by tracked_since."""
    e = events.select("provider", "ev", "d", F.when(F.col("ev") == "removed", F.coalesce(F.col("verified").cast("string"), F.lit("null"))).alias("verified"))
    e.createOrReplaceTempView("vacantia_coverage")
    sets = events.sparkSession.sql("SELECT provider, ev, d, verified, count(*) AS n, grouping_id(provider, ev, d, verified) AS g FROM vacantia_coverage GROUP BY GROUPING SETS ((provider), (ev), (d), (verified))")
    kind = F.when(F.col("g") == 7, "provider").when(F.col("g") == 11, "event").when(F.col("g") == 13, "day").otherwise("verified")
    by = sets.select(kind.alias("by"), F.coalesce("provider", "ev", "d", "verified").alias("value"), "n").where("not (`by` = 'verified' and value is null)")
    boards = companies.groupBy(F.coalesce("tracked_since", F.lit("unknown")).alias("value")).agg(F.count("*").alias("n"))
    return by.unionByName(boards.select(F.lit("tracked_since").alias("by"), "value", "n"))


def csv_ready(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Fixed columns, lists joined by a bar; a column that isn't expected fails."""
    extra = set(rows.columns) - set(columns)
    if extra:
        raise ValueError(f"unexpected columns {sorted(extra)}")
    kinds = dict(rows.dtypes)
    return rows.select(*[F.array_join(c, "|").alias(c) if kinds[c].startswith("array") else F.col(c) for c in columns])


def write_archive(events: DataFrame, path: str) -> None:
    """Events as gzipped JSON lines by day; a run replaces only the days it has, nulls are written."""
    events.repartition("d").sortWithinPartitions("provider", "company", "ev", "job_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").option("compression", "gzip").partitionBy("d").json(path)


def replace_pair(spark: SparkSession, outputs: list[tuple[DataFrame, str, str]]) -> None:
    """Write several (frame, format, path) beside their places, then put all in place; on a failure all old ones come back. Empty frames keep the old ones."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(outputs[0][2]).getFileSystem(conf)
    for df, kind, path in outputs:
        df.write.mode("overwrite").format(kind).options(nullValue="", ignoreNullFields="false", header="true").save(f"{path}.new")
        if df.limit(1).count() == 0:
            raise ValueError(f"{path}: nothing to write; the old output is kept")
    moved: list[str] = []
    try:
        for _, _, path in outputs:
            if fs.exists(at(path)):
                fs.delete(at(f"{path}.old"), True)
                if not fs.rename(at(path), at(f"{path}.old")):
                    raise OSError(f"{path} can't be moved away")
            moved.append(path)
            if not fs.rename(at(f"{path}.new"), at(path)):
                raise OSError(f"{path} can't be put in place")
    except Exception:
        for path in moved:
            if fs.exists(at(f"{path}.old")):
                fs.delete(at(path), True)
                fs.rename(at(f"{path}.old"), at(path))
        raise
    for _, _, path in outputs:
        fs.delete(at(f"{path}.old"), True)
