"""Operator 1, SimHash near-duplicates: fingerprints linked by a pigeonring search.

A fingerprint is cut into m = distance + 2 segments that stand in a ring. Two fingerprints within the distance
agree on two segments at least, so each pair of segments is an index key. A candidate then has
to show a chain: a first segment from which, for every length l short of the whole ring, the differences
of l consecutive segments sum to at most l * distance / m (some chain must, as the average over the ring does). Only what
is left gets the full Hamming check.

A key that many distinct fingerprints share would give the square of their number in candidates. Keys of up to
``HOT_KEY`` fingerprints are paired; the fingerprints of the others are linked exactly by midpoints instead: those
at even distance 2r, or less, share a value within r bits of both, and each links to the smallest with that value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, remove_table, slices, texts_of

HOT_KEY = 32


def fingerprint(words: list[bytes], shingle: int) -> int:
    """SimHash over the XXH64 (seed 42) of space-joined shingles: a bit is 1 if set in over half of them. No words: zero."""
    import numpy as np
    import xxhash

    if not words:
        return 0
    text, at, starts, ends = b" ".join(words), 0, [], []
    for w in words:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    k = min(shingle, len(words))
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, dtype="int64"), len(words) - k + 1
    for low in range(0, n, 1 << 16):
        h = np.array([digest(text[s:e], 42) for s, e in zip(starts[low : min(n, low + (1 << 16))], ends[low + k - 1 : k - 1 + min(n, low + (1 << 16))], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def simhash(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, fp bigint) of every row: whole text, A-Z lower-cased, words parted by ASCII white space. Null text: zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = [fingerprint(t.encode().lower().split(), shingle) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f - (1 << 64) if f >> 63 else f for f in fps], pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def _segments(distance: int) -> list[int]:
    """Masks of the ring's segments, as signed 64-bit integers."""
    m = distance + 2
    bounds = [64 * i // m for i in range(m + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    return [x - (1 << 64) if x >> 63 else x for x in masks]


def _chain(x: Column, distance: int) -> Column:
    """Whether the differing bits ``x`` have a chain whose every length short of the ring is within its proportional budget."""
    masks = _segments(distance)
    m = len(masks)
    diff = [F.bit_count(x.bitwiseAND(F.lit(k))) for k in masks]
    found = F.lit(False)
    for first in range(m):
        total, ok = F.lit(0), F.lit(True)
        for length in range(1, m):
            total = total + diff[(first + length - 1) % m]
            ok = ok & (total * m <= length * distance)
        found = found | ok
    return found


def link_fingerprints(fps: DataFrame, distance: int = 2, hot_key: int = HOT_KEY) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps`` (fp bigint, stored): enough to join all that are within ``distance`` bits, and none beyond.

    ``distance`` must be even and small. Fingerprints that only share cold keys get all their links; hot ones a star for each midpoint.
    """
    masks = _segments(distance)
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(masks[i] | masks[j])).alias("v")) for k, (i, j) in enumerate(combinations(range(len(masks)), 2))])
    index = fps.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
    sizes = index.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    shared = index.join(sizes, ["k", "v"])
    near = lambda a, b: (a < b) & _chain(a.bitwiseXOR(b), distance) & (F.bit_count(a.bitwiseXOR(b)) <= distance)
    lists = shared.where(F.col("n") <= hot_key).groupBy("k", "v").agg(F.collect_list("fp").alias("fps"))
    pairs = lists.select(F.explode(F.flatten(F.transform("fps", lambda a: F.transform(F.filter("fps", lambda b: near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("e")).select("e.a", "e.b")
    hot = shared.where(F.col("n") > hot_key).select("fp").distinct()
    flips = [0] + [sum(1 << b for b in c) for r in range(1, distance // 2 + 1) for c in combinations(range(64), r)]
    middle = hot.select("fp", F.explode(F.transform(F.array(*[F.lit(x - (1 << 64) if x >> 63 else x) for x in flips]), lambda x: x.bitwiseXOR(F.col("fp")))).alias("mid"))
    least = middle.groupBy("mid").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    stars = middle.join(least, "mid").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def simhash_components(docs: DataFrame, shingle: int = 3, distance: int = 2, hot_key: int = HOT_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    fingerprint is 16 lowercase hex digits; fingerprints that differ in at most ``distance`` bits are linked, and
    component_id is the smallest doc_id that links reach, the row's own included. Null and empty texts have fingerprint
    zero and are linked like any other. Rows with a null doc_id take part; their component_id is the smallest known
    doc_id reached, or null. Repeated rows are returned each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows, _ = materialize(simhash(docs, shingle, id_col, text_col), "simhash")
    fps, _ = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    links, links_path = materialize(link_fingerprints(fps.select("fp"), distance, hot_key), "simhash-links")
    labels = connected_components(links, "simhash")
    remove_table(spark, links_path)
    whole = fps.join(labels, fps["fp"] == labels["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("c"))
    least = whole.groupBy("c").agg(F.min("least").alias("component_id"))
    named = whole.select("fp", "c").join(least, "c").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
