"""Operator 4, mixing sources to target weights: Poisson replication.

A source whose target share is w, of ``total`` documents in all, has a mean repetition rate of total * w / its documents. Each
document draws a uniform number from a hash of its id and a seed, and is repeated as often as the inverted Poisson
distribution says: the number of k whose cumulative probability is below the draw. Copies are then put in a global
order by a hash. Draws depend on nothing but id and seed, so a lost task repeats them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tables of rates up to this many sources and probabilities are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES, BROADCAST_STEPS = 10_000, 1_000_000


def draw(id_col: str, seed: int) -> Column:
    """Uniform number in [0, 1) of 52 bits from the MD5 of id and seed; a null id draws as the empty text."""
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source_col: str, weights: dict[str, float] | None, total: int | None) -> DataFrame:
    """(source, rate) for all sources of ``docs``; equal weights where none are given, 0 for sources that are not named."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))]), F.coalesce("source", F.lit(""))), F.lit(0.0)) if weights else F.lit(0.0)
    found = sizes.select("n", weight.alias("w")).agg(F.sum("n"), F.sum("w")).first()
    wanted, sum_w = total if total is not None else found[0] or 0, found[1] or 0.0
    return sizes.select("source", (F.lit(float(wanted)) * weight / sum_w / F.col("n") if sum_w > 0 else F.lit(0.0)).alias("rate"))


def cumulative(rate: Column) -> Column:
    """Poisson probabilities of at most k for k = 0, 1, ... until they can't be told from 1, summed from logarithms so that large rates work too."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = acc["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(acc["all"], F.array(total)).alias("all"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["all"])).otherwise(F.array(F.lit(1.0)))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = 7, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Copies of ``docs`` with all their columns, copy (0, 1, ...) and shuffle_key, in the global order of shuffle_key.

    ``weights`` are target weights by source (equal for all sources if None); sources that it does not name have weight 0. ``total`` is
    the mean number of copies in all (the number of documents if None). A null source is a source of its own, with key "" in
    ``weights``. Repeated rows of an id draw alike and are each repeated. An empty table gives an empty result. Columns named copy or
    shuffle_key are replaced.
    """
    table = rates(docs, source_col, weights, total).withColumn("__cdf", cumulative(F.col("rate")))
    bounds = table.agg(F.count("*"), F.sum(F.size("__cdf"))).first()
    small = bounds[0] <= BROADCAST_SOURCES and (bounds[1] or 0) <= BROADCAST_STEPS
    table = table.select(F.col("source").alias("__source"), "__cdf")
    kept = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    own = docs.select(*[F.col(f"`{c}`") for c in kept])
    joined = own.join(F.broadcast(table) if small else table, own[source_col].eqNullSafe(table["__source"]))
    times = F.size(F.filter("__cdf", lambda p: p < F.col("__draw")))
    copies = joined.withColumn("__draw", draw(id_col, seed)).withColumn("__times", times).where("__times > 0")
    copies = copies.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.sequence(F.lit(0), F.col("__times") - 1)).alias("copy"))
    key = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("copy").cast("string"), F.lit(f"{seed}")).cast("binary"))
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key")


MIX_SQL = """
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, (SELECT count(*) FROM documents)::DOUBLE / (SELECT count(*) FROM sizes) / n AS rate FROM sizes),
steps AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rates),
cdf AS (SELECT source, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM steps),
draws AS (SELECT doc_id, source, ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':7')[1:13])::BIGINT / 4503599627370496.0 AS u FROM documents),
times AS (SELECT d.doc_id, d.source, count(*) AS n FROM draws d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.p < d.u GROUP BY d.doc_id, d.source),
copies AS (SELECT doc_id, source, unnest(range(0, n))::INTEGER AS copy FROM times)
SELECT doc_id, source, copy, md5(coalesce(doc_id::VARCHAR, '') || ':' || copy || ':7') AS shuffle_key FROM copies
"""
