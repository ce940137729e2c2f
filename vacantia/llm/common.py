"""Helpers shared by the corpus operators: shared-folder tables, Arrow batches, components.

Lineage is cut by writing Parquet below the folder that the session names in
``spark.checkpoint.dir``; such tables survive the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where the session names none, a temporary one, if all tasks run on this machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="vacantia-")
    return _FALLBACK[app]


def table_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/vacantia/{label}-{uuid.uuid4().hex}"


#: Rows, of a few numbers each, that one task writes where their number is known before.
ROWS_A_TASK = 50_000


def materialize(df: DataFrame, label: str, rows: int | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared folder and read it again. Returns the table and its path.

    With ``rows``, about how many short rows there will be at most, so many tasks write as these need, instead of one a shuffle partition.
    """
    spark = df.sparkSession
    path = table_path(spark, label)
    (df if rows is None else df.coalesce(rows // ROWS_A_TASK + 1)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table written by :func:`materialize` that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of at most ``rows`` rows, so that a worker's Python objects stay few."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


#: Keys with more than one in so many of the rows are joined by broadcast; there are at most so many of them.
FREQUENT = 1000


def join_frequent(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key`` with a stored table that has each key once, and in ``n`` about how many rows ``left`` has of it.

    Rows of frequent keys stay where they are, and what ``right`` has for those, at most FREQUENT rows, goes to them; only the others are shuffled.
    """
    total = right.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > max(1, total // FREQUENT)
    hot = F.broadcast(right.where(often))
    rest = left.join(F.broadcast(right.where(often).select(key)), key, "left_anti").join(right.where(~often), key)
    return left.join(hot, key).unionByName(rest)


#: Rows of an Arrow batch of documents.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """From now on this session sends Python workers Arrow batches of at most BATCH_ROWS rows; a smaller limit stays.

    By default a batch has 10,000 rows, which is all of most tasks' documents: the executor and the worker each hold all that it reads and
    returns at once, twice while a buffer grows, and keep much of that memory afterwards. The limit holds when a plan is run, so it is not set back.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def release() -> None:
    """Give memory that this process has freed back to the system; the C library and Arrow would keep it."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


_OWNER: list[tuple[str, Callable[[], None]]] = []


def claim(name: str, clear: Callable[[], None]) -> None:
    """Make ``name`` the one table of a Python worker that outlives its tasks; the one before, if another's, is cleared.

    Workers serve one operator after the other, and the tables of all of them together would outgrow an executor.
    """
    if not _OWNER or _OWNER[0][0] != name:
        for _, other in _OWNER:
            other()
        if _OWNER:
            release()
        _OWNER[:] = [(name, clear)]


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """Components of the graph with ``edges`` (a, b: bigint), as (node, component); component is the smallest node.

    Alternating large-star and small-star steps, each a group-by-minimum and a join on the node, so that the
    number of rows never exceeds about twice that of the edges and no node's neighbours are ever gathered.
    Every step is written to the shared folder. Self-links and repeats are ignored; nodes without a
    link to another are not in the result; without edges the result is empty.
    """
    spark = edges.sparkSession
    pair = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    table, path = materialize(pair, f"{label}-edges")
    seen, rows = None, table.count()
    while rows:
        both = table.union(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large, large_path = materialize(large, f"{label}-large", 2 * rows)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        small = small.select("e.a", "e.b").where("a <> b").distinct()
        fresh, fresh_path = materialize(small, f"{label}-small", 2 * rows)
        now = fresh.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        remove_table(spark, path)
        remove_table(spark, large_path)
        table, path = fresh, fresh_path
        if now == seen or now[0] == 0:
            break
        seen, rows = now, now[0]
    low = table.groupBy("a").agg(F.min("b").alias("b"))
    return low.select(F.col("a").alias("node"), F.col("b").alias("component")).union(table.select(F.col("b"), F.col("b")).distinct())
