"""Near-duplicate groups at a Jaccard similarity of word shingles, for the pipeline: exact candidates, exact check.

Candidates come from a prefix filter, which loses no pair: with all shingles in one order, two sets whose similarity reaches the threshold
share one of the first n - ceil(threshold * n) + 1 of each. The order is that of hashes, but shingles that stand in
many prefixes come last, so that what is common files few texts; any such order gives the same links. How far down the order
a shared shingle stands in both texts bounds what they can share at all, which most pairs fail before their texts are read.

The first rounds compare a large key's texts only with one leader of the key, which then has had its turn there, and small keys'
texts with each other. Links join texts to components, and texts of one component need no comparing; the last
round compares all others that are left of a key, block by block and by maps of their shingles, so that no pair is
missed. A shingle whose place is empty in the other map is not shared, which bounds what two texts share.

With a ``distance`` the SimHash fingerprints of operator 1 come first: texts whose fingerprints link are joined as there. As no budget of
differing bits holds all pairs of a similarity on shingles, the search above then adds the links that fingerprints miss, between
texts that they have not joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, join_frequent, materialize, remove_table, slices, texts_of
from .simhash import link_fingerprints, simhash

WORDS, SIMILARITY = 5, 0.8
#: Shingles in more prefixes than this come last in the order, the most frequent ones up to a bound that fits every task.
HOT, MOST_HOT = 32, 1 << 16
#: Texts of a key that are all compared at once; rounds in which larger keys are compared with a leader.
PAIRED, ROUNDS = 16, 3
#: Texts of a key that the last round compares in one go, and bits of the maps by which it does.
BLOCK, MAP_BITS = 1024, 2048


def similarity(a: str, b: str, words: int = WORDS) -> float:
    """Jaccard similarity of the sets of word shingles, lower-cased; shorter texts are one shingle."""
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def shingle_prefix(text: str, words: int = WORDS, threshold: float = SIMILARITY, hot=None) -> tuple[int, list[int], bytes]:
    """Number of distinct shingles of :func:`similarity`, the hashes that come first, those in ``hot`` (sorted) after all others, and a map of all."""
    import math

    import numpy as np
    import xxhash

    w = text.lower().split()
    h = np.unique(np.array([xxhash.xxh3_64_intdigest(" ".join(w[i : i + words])) for i in range(max(1, len(w) - words + 1))], dtype="uint64").view("int64"))
    n = len(h)
    places = np.zeros(MAP_BITS, "u1")
    places[h & (MAP_BITS - 1)] = 1
    if hot is not None and len(hot):
        last = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
        h = np.concatenate([h[~last], h[last]])
    return n, h[: n - math.ceil(threshold * n - 1e-6) + 1].tolist(), np.packbits(places).tobytes()


def block_pairs(members: list[dict], one: bool, threshold: float) -> list[tuple[int, int]]:
    """Pairs (smaller node first) of a key's members in different components that can reach ``threshold``: of all if ``one``, else of the two sides."""
    import numpy as np

    node, component, n, pos = (np.array([m[c] for m in members], dtype="int64") for c in ("node", "component", "n", "pos"))
    side = np.array([m["side"] for m in members])
    maps = np.frombuffer(b"".join(m["map"] for m in members), "uint64").reshape(len(members), -1)
    full = np.bitwise_count(maps).sum(axis=1, dtype="int64")
    pairs = []
    for i in range(len(members)):
        need = np.ceil(threshold / (1 + threshold) * (n + n[i]) - 1e-6)
        ok = (component != component[i]) & (np.minimum(n - pos, n[i] - pos[i]) >= need) & (node > node[i] if one else side > side[i])
        j = np.nonzero(ok)[0]
        common = np.bitwise_count(maps[j] & maps[i]).sum(axis=1, dtype="int64")
        j = j[np.minimum(n[j] - full[j], n[i] - full[i]) + common >= need[j]]
        pairs += [(min(a, b), max(a, b)) for a in [int(node[i])] for b in node[j].tolist()]
    return pairs


def fingerprint_links(texts: DataFrame, distance: int, shingle: int = 3) -> DataFrame:
    """Links (a, b) that join all texts (node, text), repeats allowed, whose SimHash fingerprints link at ``distance`` bits or fewer: to the smallest node of each component."""
    spark = texts.sparkSession
    prints, prints_path = materialize(simhash(texts, shingle, "node").select(F.col("doc_id").alias("node"), "fp").distinct(), "neardup-fingerprints")
    near, near_path = materialize(link_fingerprints(prints.select("fp").distinct(), distance), "fingerprint-links")
    labels, labels_path = materialize(connected_components(near, "fingerprints").withColumnRenamed("node", "member"), "fingerprint-groups")
    whole = prints.join(labels, F.col("fp") == F.col("member"), "left").select("node", F.coalesce("component", "fp").alias("c"))
    heads = whole.groupBy("c").agg(F.min("node").alias("b"), F.max("node").alias("last"), F.count("*").alias("n")).where("b < last").drop("last")
    heads, heads_path = materialize(heads, "fingerprint-heads")
    links, _ = materialize(join_frequent(whole, heads, "c").where("node <> b").select(F.col("node").alias("a"), "b"), "neardup-links")
    for path in (prints_path, near_path, labels_path, heads_path):
        remove_table(spark, path)
    return links


def near_duplicate_groups(docs: DataFrame, words: int = WORDS, threshold: float = SIMILARITY, distance: int | None = None) -> DataFrame:
    """(doc_id, group) of every row: group is the smallest doc_id of the near-duplicates that links reach, the row itself included.

    Rows with equal texts are linked, and all those whose texts have similarity ``threshold`` on ``words``-word shingles, and, with ``distance``, those
    whose SimHash fingerprints differ in so many bits or fewer (even).
    Null texts count as empty. A group of rows without any id has a null group.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.xxhash64("text"))
    rows, _ = materialize(own.select("doc_id", "node"), "neardup-rows")

    def filed(texts: DataFrame, hot=None) -> DataFrame:
        def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = [shingle_prefix(t, words, threshold, hot) for t in texts_of(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.list_(pa.int64())), pa.array([x[2] for x in found], pa.binary())], names=["node", "n", "keys", "map"])

        return texts.select("node", "text").mapInArrow(file, "node bigint, n int, keys array<bigint>, map binary").dropDuplicates(["node"])

    first, first_path = materialize(filed(own), "shingle-prefixes")
    often = first.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    hot = sorted(r["key"] for r in often.orderBy(F.desc("n"), "key").limit(MOST_HOT).collect())
    prints = first
    if hot:
        import numpy as np

        common = F.broadcast(spark.createDataFrame([(k,) for k in hot], "key bigint"))
        anew, anew_path = materialize(first.select("node", F.explode("keys").alias("key")).join(common, "key", "left_semi").select("node").distinct(), "hot-texts")
        again, again_path = materialize(filed(own.join(anew, "node", "left_semi"), np.array(hot, dtype="int64")), "shingle-prefixes")
        prints = first.join(anew, "node", "left_anti").unionByName(again)
    index = prints.select("node", "n", F.posexplode("keys").alias("pos", "key"))
    # keys with the same texts are one: the first of them, which is the first for each of its texts, as all have the same order
    ends = index.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("texts"), F.min_by("pos", "node").alias("first"))
    ends = ends.where("lo <> hi").groupBy("lo", "hi", "size", "texts").agg(F.min_by("key", F.struct("first", "key")).alias("key")).select("key", "size", F.col("size").alias("n"))
    ends, ends_path = materialize(ends, "distinct-keys")
    shared = join_frequent(index.withColumnRenamed("n", "shingles"), ends, "key").select("key", "node", F.col("shingles").alias("n"), "pos", "size")
    shared, shared_path = materialize(shared, "shared-keys")
    remove_table(spark, ends_path)
    filings = shared.count()  # no table of keys that follows has more rows
    rank, rank_path = materialize(shared.groupBy("node").agg(F.sum("size").alias("weight")), "leader-weights", filings)
    standing, standing_path = materialize(shared.join(rank, "node").select("key", "node", "n", "pos", "weight"), "standing", filings)
    texts, texts_path = materialize(own.select("node", "text").join(rank.select("node"), "node", "left_semi").dropDuplicates(["node"]), "shared-texts")
    maps, maps_path = materialize(first.select("node", "map").join(rank.select("node"), "node", "left_semi"), "shingle-maps")
    for path in (first_path, shared_path, rank_path, *((anew_path, again_path) if hot else ())):
        remove_table(spark, path)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            pairs = block_pairs(batch.column(1)[0].as_py(), batch.column(0)[0].as_py(), threshold)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ok = pa.array([similarity(a, b, words) >= threshold for a, b in zip(texts_of(batch.column(2)), texts_of(batch.column(3)), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    # the most that two texts share if this key's shingle is the first they share
    reach = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos")) >= F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("x.n") + F.col("y.n")) - 1e-6)
    apart = (F.col("x.component") != F.col("y.component")) & reach
    links = spark.createDataFrame([], "a bigint, b bigint")
    tested, tested_paths, labels, labels_path = links, [], None, None
    if distance is not None:
        links = fingerprint_links(own.select("node", "text"), distance)
        labels, labels_path = materialize(connected_components(links, "neardup"), "neardup-groups")
    for turn in range(ROUNDS + 1):
        at = standing.withColumn("component", F.col("node"))
        if labels is not None:
            at = standing.join(labels.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left").drop("member").withColumn("component", F.coalesce("component", "node"))
        keys = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"), F.max_by(F.struct("key", "node", "n", "pos", "component"), F.struct("weight", "node")).alias("leader"))
        keys = keys.where("lo <> hi").select("key", "size", (F.col("size") <= PAIRED).alias("whole"), "leader")
        live, live_path = materialize(at.join(keys, "key"), "live-keys", filings)
        every = live.where("whole")
        pairs = every.alias("x").join(every.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        rest = live.where("not whole")
        led = rest.where("node <> leader.node").select(F.struct("node", "n", "pos", "component").alias("x"), F.col("leader").alias("y")).where(apart)
        if turn < ROUNDS:
            pairs = pairs.union(led.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")))
        else:
            blocks = F.ceil(F.col("size") / BLOCK).cast("int")
            dealt = rest.join(maps, "node").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            dealt = dealt.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), F.struct("node", "component", "n", "pos", (F.col("own") > F.col("other")).alias("side"), "map").alias("member"))
            dealt = dealt.groupBy("key", "lo", "hi").agg(F.collect_list("member").alias("members")).select((F.col("lo") == F.col("hi")).alias("one"), "members").repartition(max(12, 4 * spark.sparkContext.defaultParallelism))
            pairs = pairs.union(dealt.mapInArrow(compare, "a bigint, b bigint"))
        pairs = pairs.distinct()
        pairs, pairs_path = materialize(pairs.join(tested, ["a", "b"], "left_anti") if tested_paths else pairs, "near-pairs")
        tested, tested_paths = tested.union(pairs), [*tested_paths, pairs_path]
        both = pairs.join(texts.withColumnRenamed("node", "a").withColumnRenamed("text", "x"), "a").join(texts.withColumnRenamed("node", "b").withColumnRenamed("text", "y"), "b")
        found, _ = materialize(both.select("a", "b", "x", "y").mapInArrow(alike, "a bigint, b bigint"), "neardup-links")
        links = links.union(found)
        remove_table(spark, standing_path)
        standing, standing_path = materialize((rest.where("node <> leader.node") if turn < ROUNDS else rest.limit(0)).select("key", "node", "n", "pos", "weight"), "standing", filings)
        remove_table(spark, live_path)
        if labels is None or found.limit(1).count():
            if labels_path:
                remove_table(spark, labels_path)
            labels, labels_path = materialize(connected_components(links, "neardup"), "neardup-groups")
        if not standing.limit(1).count():
            break
    for path in (standing_path, texts_path, maps_path, *tested_paths):
        remove_table(spark, path)
    least = rows.groupBy("node").agg(F.min("doc_id").alias("least")).join(labels.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left")
    least = least.select("node", "least", F.coalesce("component", "node").alias("component"))
    groups = least.groupBy("component").agg(F.min("least").alias("group"))
    return rows.join(least.join(groups, "component").select("node", "group"), "node").select("doc_id", "group")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = SIMILARITY, distance: int | None = None) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest doc_id.

    Rows with a null doc_id stay, as nothing names them; repeated rows of a doc_id that stays all stay. All columns are kept.
    """
    groups = near_duplicate_groups(docs, words, threshold, distance)
    lost, _ = materialize(groups.where("doc_id <> group").select(F.col("doc_id").alias("__lost")).distinct(), "neardup-lost")
    return docs.join(lost, docs["doc_id"].cast("bigint") == lost["__lost"], "left_anti")
