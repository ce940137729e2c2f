"""Operator 2, media columns: local image descriptors that find cropped or edited copies.

Corners are taken at several scales, as many as the image's area gives room for, each with an orientation from the intensity centroid of its surroundings and
256 binary tests on a pattern turned by it. Descriptors are cut into TABLES parts; two that differ in fewer bits than there
are tables agree on a part for sure. Each part, with some bits of the next, is a hash table. The images of an entry are first paired with the one
at its head, which joins most copies, so that a group of them makes as many pairs as it has images; then all that are not in
one group yet are paired with each other, in an entry of many block by block, so that no pair of an entry is left out
but those that cannot get enough votes: pairs that have smaller entries too are looked up in large ones if these can make up the votes, others need as many points there. Pairs of
corners whose descriptors are near vote for a turn, a zoom and a shift; two images are linked if enough distinct points agree, and copies are the components of links.
Each image is first tested with the one that it shares most points with: with a head on a few of them, with the others of its entries on all. Only then are the pairs stored of
images that are not in one group by then, and tested on all their points, the best of each group before the others where they are many.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, materialize, remove_table, slices, small_batches

BITS, TABLES = 256, 8
#: Bits of the next part that an entry has besides its own.
BESIDE = 16
#: Bits in which the descriptors of the same point may differ.
NEAR = 64
SCALES = (1.0, 1.5, 2.25)
RADIUS = 11
#: Pixels of a scaled image for each corner that is kept of it, the strongest first, and how many are kept of a small one.
CORNER_AREA, CORNERS = 120, 24
#: Points of an entry whose pairs are all made at once; points that are compared in one go of larger ones.
PAIRED, BLOCK = 32, 1024
VOTES = 5
#: Pairs of points on which each image is first tested with one other; images that these don't join are tested on all.
TRIED = 16


def decode(data: bytes | None):
    """Grey image (float array) of binary PGM or PPM bytes; None for anything else."""
    import re

    import numpy as np

    m = re.match(rb"(P[56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s", data or b"")
    if not m or not 0 < int(m[4]) < 256:
        return None
    w, h, bands = int(m[2]), int(m[3]), 3 if m[1] == b"P6" else 1
    pixels = np.frombuffer(data, "u1", offset=m.end())
    if w * h == 0 or len(pixels) < w * h * bands:
        return None
    return pixels[: w * h * bands].reshape(h, w, bands).astype(float).mean(axis=2)


def encode(image) -> bytes:
    import numpy as np

    a = np.clip(np.rint(image), 0, 255).astype("u1")
    return b"P5 %d %d 255\n" % (a.shape[1], a.shape[0]) + a.tobytes()


def _box(a, r: int):
    """Mean over squares of side 2r + 1, the edges repeated."""
    import numpy as np

    s = np.pad(np.pad(a, r, mode="edge").cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n = 2 * r + 1
    return (s[n:, n:] - s[:-n, n:] - s[n:, :-n] + s[:-n, :-n]) / n**2


@lru_cache(None)
def _pattern():
    import numpy as np

    draw = np.random.default_rng(11)
    return np.clip(draw.normal(0, RADIUS / 2.2, (BITS, 4)), -RADIUS + 1, RADIUS - 1)


@lru_cache(None)
def _disc():
    import numpy as np

    y, x = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
    inside = x**2 + y**2 <= RADIUS**2
    return x[inside], y[inside]


def describe(image) -> list[tuple[float, float, float, float, bytes]]:
    """Corners of a grey image: x, y, scale, angle and descriptor; none where it is smaller than the pattern."""
    import numpy as np

    found = []
    dx, dy = _disc()
    for scale in SCALES:
        h, w = int(image.shape[0] / scale), int(image.shape[1] / scale)
        if min(h, w) < 2 * RADIUS + 8:
            break
        yy, xx = (np.arange(h) + 0.5) * scale - 0.5, (np.arange(w) + 0.5) * scale - 0.5
        small = _box(image, int(scale)) if scale > 1 else image
        small = small[np.clip(np.rint(yy), 0, image.shape[0] - 1).astype(int)][:, np.clip(np.rint(xx), 0, image.shape[1] - 1).astype(int)]
        smooth = _box(small, 1)
        gy, gx = np.gradient(smooth)
        a, b, c = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
        strength = a * b - c * c - 0.05 * (a + b) ** 2
        m = RADIUS + 2
        inner = strength[m:-m, m:-m]
        top = np.max([strength[m + i : strength.shape[0] - m + i, m + j : strength.shape[1] - m + j] for i in (-2, -1, 0, 1, 2) for j in (-2, -1, 0, 1, 2)], axis=0)
        y, x = np.nonzero((inner == top) & (inner > 1.0))
        order = np.argsort(-inner[y, x], kind="stable")[: max(CORNERS, h * w // CORNER_AREA)]
        y, x = y[order] + m, x[order] + m
        if not len(y):
            continue
        smooth = _box(small, 2)
        around = smooth[y[:, None] + dy, x[:, None] + dx]
        angle = np.arctan2((around * dy).sum(1), (around * dx).sum(1))
        p, cos, sin = _pattern(), np.cos(angle)[:, None], np.sin(angle)[:, None]
        value = []
        for k in (0, 2):
            px, py = p[:, k] * cos - p[:, k + 1] * sin, p[:, k] * sin + p[:, k + 1] * cos
            value.append(smooth[np.clip(np.rint(y[:, None] + py), 0, h - 1).astype(int), np.clip(np.rint(x[:, None] + px), 0, w - 1).astype(int)])
        bits = np.packbits(value[0] < value[1], axis=1)
        found += [(float((u + 0.5) * scale - 0.5), float((v + 0.5) * scale - 0.5), scale, float(t), d.tobytes()) for u, v, t, d in zip(x, y, angle, bits, strict=True)]
    return found


def near_points(members: list[dict], one: bool) -> list[tuple[int, int, int, int]]:
    """(node, k, first, fk), node the larger, of an entry's points in different groups whose descriptors are near: of all if ``one``, else of the two sides."""
    import numpy as np

    node, k, component = (np.array([m[c] for m in members], dtype="int64") for c in ("node", "k", "component"))
    side, bits = np.array([m["side"] for m in members]), np.array([m["bits"] for m in members], dtype="int64").view("uint64")
    found = []
    for i in range(len(members)):
        j = np.nonzero((component != component[i]) & (node > node[i] if one else (side > side[i]) & (node != node[i])))[0]
        j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype="int64") <= NEAR]
        found += [(a, b, c, d) if a > c else (c, d, a, b) for c, d in [(int(node[i]), int(k[i]))] for a, b in zip(node[j].tolist(), k[j].tolist(), strict=True)]
    return found


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        found = near_points(batch.column(1)[0].as_py(), batch.column(0)[0].as_py())
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int32()))], names=["node", "k", "first", "fk"])


def shared_points(batch: pa.RecordBatch, votes: int, best: bool) -> Iterator[tuple]:
    """(node, first, m, component, beside, several) of the pairs of each image, a row of the batch, that can get enough votes; with ``best`` the one with the most points.

    A row has the image's group, how many of its points are in large entries, and of each other entry that it is in its point and, in lists as long
    as each other, the points there of images that come before it in other groups.
    """
    import numpy as np

    node, component, own, entries = (batch.column(i) for i in range(4))
    k, *lists = entries.flatten().flatten()
    sizes = lists[0].value_lengths().to_numpy()
    row = np.repeat(np.repeat(np.arange(batch.num_rows), entries.value_lengths().to_numpy()), sizes)
    k, (first, fk, beside, other) = np.repeat(k.to_numpy(), sizes), (x.flatten().to_numpy() for x in lists)
    order = np.lexsort((first, row))
    row, first = row[order], first[order]
    begin = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (first[1:] != first[:-1])][: len(row)])
    size, at = np.diff(np.r_[begin, len(row)]), order[begin]
    own = own.to_numpy()[row[begin]]
    several = (own > 0) & (other[at] > 0) & (not best)
    found: dict[int, tuple] = {}
    for i in np.flatnonzero(size + np.where(several, np.minimum(own, other[at]), 0) >= votes):
        j = order[begin[i] : begin[i] + size[i]]
        m = sorted({*zip(k[j].tolist(), fk[j].tolist(), strict=True)})
        more = (int(own[i]), int(other[at[i]])) if several[i] else (0, 0)
        if min(len({x[c] for x in m}) + more[c] for c in (0, 1)) < votes:
            continue
        r = int(row[begin[i]])
        pair = (node[r].as_py(), int(first[begin[i]]), m, component[r].as_py(), int(beside[at[i]]), bool(several[i]))
        if not best:
            yield pair
        elif r not in found or len(found[r][2]) < len(m):  # of as many points the smallest first
            found[r] = pair
    yield from found.values()


def media_copies(media: DataFrame, id_col: str = "media_id", image_col: str = "image", votes: int = VOTES) -> DataFrame:
    """(media_id bigint, n_corners, group_id) of every row of ``media``.

    group_id is the smallest media_id that links reach, the row's own included. Equal bytes are linked; images that are cropped, turned, zoomed or
    edited copies are linked if ``votes`` distinct points agree on the move. A null or unreadable image has no corners; equal ones of
    these are linked, null ones are not. Rows with a null id are returned with a null group. Repeated rows are returned each.
    """
    spark = media.sparkSession
    stored = []

    def keep(table: DataFrame, label: str) -> DataFrame:
        table, path = materialize(table, label)
        stored.append(path)
        return table

    kind = "array<struct<x:float,y:float,scale:float,angle:float,bits:array<bigint>>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        place = [(c, pa.float32()) for c in ("x", "y", "scale", "angle")]
        types = pa.list_(pa.struct([*place, ("bits", pa.list_(pa.int64()))]))
        for batch in slices(batches, 64):
            points = [describe(i) if (i := decode(x)) is not None else [] for x in batch.column(2).to_pylist()]
            rows = [[{**dict(zip(("x", "y", "scale", "angle"), p, strict=False)), "bits": np.frombuffer(p[4], "<i8").tolist()} for p in ps] for ps in points]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, points), pa.int32()), pa.array(rows, types)], names=["media_id", "content", "n_corners", "points"])

    # images are read once and never shuffled; copies of the same bytes are one node from here on
    named = media.select(F.col(id_col).cast("bigint").alias("media_id"), F.sha2(image_col, 256).alias("content"), F.col(image_col).alias("image"))
    described, _ = materialize(named.mapInArrow(run, f"media_id bigint, content string, n_corners int, points {kind}"), "media-points")
    known = described.where("media_id is not null and content is not null").groupBy("content").agg(F.min("media_id").alias("least"), F.max("n_corners").alias("corners"))
    # a number that packs well: the id, but for further images under the same one
    turn = F.row_number().over(Window.partitionBy("least").orderBy("content"))
    own, _ = materialize(known.withColumn("node", F.when(turn == 1, F.col("least")).otherwise(F.xxhash64("content"))), "media-contents")
    n_images = own.count()
    images = described.select("content", "media_id", "points").join(own.where("corners > 0").select("content", F.col("least").alias("media_id"), "node"), ["content", "media_id"])
    points = images.select("node", F.posexplode("points").alias("k", "p"))
    each = BITS // TABLES
    part = lambda t: F.shiftrightunsigned(F.get(F.col("p.bits"), t * each // 64), t * each % 64).bitwiseAND((1 << each) - 1)
    beside = lambda t: part((t + 1) % TABLES).bitwiseAND((1 << BESIDE) - 1)
    keys = F.explode(F.array(*[F.xxhash64(F.lit(t), part(t), beside(t)) for t in range(TABLES)])).alias("v")
    whole = Window.partitionBy("v")
    shared = points.select("node", "k", keys).select("*", F.count("*").over(whole).alias("n"), F.min(F.struct("node", "k")).over(whole).alias("head"), F.max("node").over(whole).alias("last"))
    shared = keep(shared.where("head.node < last").select("v", "node", "k", F.col("n").cast("int").alias("n"), "head"), "media-entries")

    size_of = lambda c: F.size(F.array_distinct(c))

    def agreed(pairs: DataFrame) -> DataFrame:
        """Those of the pairs of images (node, first, m: their pairs of points) of which enough points are near and agree."""
        match = keep(pairs.select("node", "first", F.explode("m").alias("m")).select("node", "m.k", "first", "m.fk"), "media-matches")
        wanted = match.select("node").union(match.select("first")).distinct()
        place = points.join(wanted, "node", "left_semi").select("node", "k", "p.*")
        near = match.join(place, ["node", "k"]).join(place.select(F.col("node").alias("first"), F.col("k").alias("fk"), F.struct("x", "y", "scale", "angle", "bits").alias("f")), ["first", "fk"])
        apart = F.aggregate(F.zip_with("bits", "f.bits", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, x: a + x)
        turn = F.pmod(F.col("angle") - F.col("f.angle"), F.lit(6.283185307179586))
        moved = near.where(apart <= NEAR).withColumn("zoom", F.col("scale") / F.col("f.scale")).withColumn("turn", turn)
        moved = moved.withColumn("sx", F.col("x") - F.col("zoom") * (F.cos("turn") * F.col("f.x") - F.sin("turn") * F.col("f.y"))).withColumn("sy", F.col("y") - F.col("zoom") * (F.sin("turn") * F.col("f.x") + F.cos("turn") * F.col("f.y")))
        # two grids, the second half a cell aside, so that votes on a border meet in one of them
        cells = F.array(*[F.struct(F.lit(g).alias("g"), F.round(F.log2("zoom") * 1.7).alias("z"), F.floor(F.col("turn") / 0.35 + g / 2).alias("r"), F.floor(F.col("sx") / 12 + g / 2).alias("a"), F.floor(F.col("sy") / 12 + g / 2).alias("b")) for g in (0, 1)])
        votes_of = moved.select("node", F.col("first").alias("other"), "k", "fk", F.explode(cells).alias("c")).groupBy("node", "other", "c").agg(F.count_distinct("k").alias("n"), F.count_distinct("fk").alias("m"))
        links = votes_of.where((F.col("n") >= votes) & (F.col("m") >= votes)).select(F.col("node").alias("a"), F.col("other").alias("b"))
        return keep(links.distinct(), "media-links")

    def paired(match: DataFrame) -> DataFrame:
        """The pairs (node, k, first, fk) of points by pair of images: (node, first, m)."""
        return match.groupBy("node", "first").agg(F.collect_set(F.struct("k", "fk")).alias("m"))

    def enough(pairs: DataFrame) -> DataFrame:
        """Most images that share an entry share fewer points than it takes: they go before their points are read."""
        return pairs.where((size_of("m.k") >= votes) & (size_of("m.fk") >= votes))

    def best_of_each(pairs: DataFrame) -> DataFrame:
        """Of each image (node) the pair with the most points: in a group of copies one link an image joins all."""
        return enough(pairs).groupBy("node").agg(F.max_by(F.struct("first", "m"), F.struct(F.size("m"), -F.col("first"))).alias("b")).select("node", "b.*")

    def rest_linked(pairs: DataFrame) -> DataFrame:
        """Links that join all images of which enough of the pairs of points (node, first, m, a stored table) are near and agree."""
        links, parts = None, 1
        while True:
            # two large groups have as many pairs as the product of their images, and one of these may join them: while all that is
            # left is more points than enough for every image, only the best pair is tested of each part of a group's pairs, of four times as many parts each time
            rest = pairs.select("node", "first", "m")
            if (rest.agg(F.sum(F.size("m"))).first()[0] or 0) <= votes * n_images:
                return agreed(rest) if links is None else links.union(agreed(rest))
            part = F.pmod(F.xxhash64("node", "first"), F.lit(parts)).alias("part")
            best = [pairs.groupBy(c, part).agg(F.max_by(F.struct("node", "first", "m"), F.struct(F.size("m"), "node", "first")).alias("b")).select("b.*") for c in ("own", "other")]
            tried = keep(best[0].union(best[1]).dropDuplicates(["node", "first"]), "media-best")
            found = agreed(tried)
            links, parts = found if links is None else keep(links.union(found), "media-links"), 4 * parts
            pairs = apart(rest.join(tried.select("node", "first"), ["node", "first"], "left_anti"), links)

    def apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
        """The pairs (node, first, m) that the links leave in two groups, own and other."""
        labels = keep(connected_components(links, "media"), "media-groups")
        of = lambda c, name: labels.select(F.col("node").alias(c), F.col("component").alias(name))
        named = pairs.join(of("node", "own"), "node", "left").join(of("first", "other"), "first", "left").select("node", "first", "m", F.coalesce("own", "node").alias("own"), F.coalesce("other", "first").alias("other"))
        return keep(named.where("own <> other"), "media-apart")

    # in a group of copies few points show a link; what is apart after that is paired anew with all in its entries
    with_head = paired(shared.where("node <> head.node").select("node", "k", F.col("head.node").alias("first"), F.col("head.k").alias("fk")))
    best = best_of_each(keep(enough(with_head), "media-candidates"))
    few_points = F.slice(F.array_sort(F.transform("m", lambda x: F.struct(F.xxhash64("node", x.k, x.fk).alias("h"), x.k.alias("k"), x.fk.alias("fk")))), 1, TRIED)
    links = agreed(keep(best.select("node", "first", few_points.alias("m")), "media-best"))
    labels = keep(connected_components(links, "media"), "media-groups")
    several = lambda left: left.join(left.groupBy("v").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("v"), "v", "left_semi")
    points_of = lambda table: table.groupBy("node").agg(F.count_distinct("k").alias("own"))

    def grouped(entries: DataFrame, labels: DataFrame) -> DataFrame:
        named = entries.join(labels.select(F.col("node").alias("member"), F.col("component").alias("of")), F.col("node") == F.col("member"), "left")
        return named.select("v", "n", "node", "k", F.coalesce("of", "node").alias("component"))

    def paired_apart(labels: DataFrame, points_left: DataFrame | None = None) -> DataFrame:
        """Pairs of images of different groups that smaller entries give enough votes, with ``points_left`` also those that large ones can give the rest, else the best of each image.

        Most images that share an entry share no other: each gathers the points beside its own, as lists, and counts them at once, so that no row is made for a pair that has too few.
        """
        best = points_left is None
        few = grouped(shared.where(F.col("n") <= PAIRED), labels)
        few = few.withColumn("own", F.lit(0)) if best else few.join(points_left, "node", "left").withColumn("own", F.coalesce("own", F.lit(0)))
        member = F.struct("node", "k", "component", F.col("own").cast("int").alias("own"))
        before = F.collect_list(member).over(Window.partitionBy("v").orderBy("node", "k").rowsBetween(Window.unboundedPreceding, -1))
        each = few.withColumn("b", before).withColumn("b", F.filter("b", lambda x: x.component != F.col("component"))).where(F.size("b") > 0)
        entry = F.struct("k", F.col("b.node").alias("first"), F.col("b.k").alias("fk"), F.col("b.component").alias("beside"), F.col("b.own").alias("other"))
        gathered = each.groupBy("node").agg(F.first("component").alias("component"), F.first("own").alias("own"), F.collect_list(entry).alias("entries"))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            types = (pa.int64(), pa.int64(), pa.list_(pa.struct([("k", pa.int32()), ("fk", pa.int32())])), pa.int64(), pa.int64(), pa.bool_())
            for batch in slices(batches, 64):
                found = list(shared_points(batch, votes, best))
                found = [(a, b, [{"k": x, "fk": y} for x, y in m], *rest) for a, b, m, *rest in found]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in enumerate(types)], names=["node", "first", "m", "component", "beside", "several"])

        small_batches(spark)
        return gathered.mapInArrow(count, "node bigint, first bigint, m array<struct<k:int,fk:int>>, component bigint, beside bigint, several boolean")

    # what the heads have not joined: a large group that is apart would have the square of its images in pairs, so the best pair of each image is tested before the others are stored
    best = keep(paired_apart(labels).select("node", "first", "m"), "media-best")
    links = keep(links.union(agreed(best)), "media-links")
    labels = keep(connected_components(links, "media"), "media-groups")
    # only then the large entries, those with images that are not yet in one group
    left = keep(several(keep(grouped(shared.where(F.col("n") > PAIRED), labels), "media-left")), "media-left")
    # the rows of smaller entries know how many votes the image's points in large ones can add, so that pairs are counted once and none is looked up in vain
    known = keep(paired_apart(labels, keep(points_of(left), "media-points-left")), "media-known")
    links = links.union(rest_linked(keep(enough(known).select("node", "first", "m", F.col("component").alias("own"), F.col("beside").alias("other")), "media-candidates")))
    labels = keep(connected_components(links, "media"), "media-groups")
    left = keep(several(keep(grouped(left, labels), "media-left")), "media-left")
    if left.limit(1).count():
        # pairs that smaller entries have too: with what both have in the same large ones
        of = left.groupBy("node").agg(F.first("component").alias("component"), F.collect_list(F.struct("v", "k")).alias("p"))
        again = known.where("several").select("node", "first", "m").join(of, "node").join(of.select(F.col("node").alias("first"), F.col("component").alias("beside"), F.col("p").alias("q")), "first").where("component <> beside")
        both = F.flatten(F.transform("p", lambda x: F.transform(F.filter("q", lambda y: y.v == x.v), lambda y: F.struct(x.k.alias("k"), y.k.alias("fk")))))
        again = again.select("node", "first", F.array_union("m", both).alias("m")).where((size_of("m.k") >= votes) & (size_of("m.fk") >= votes))
        # all other pairs have all their votes here: images with fewer points than that in entries of several groups can't have them
        for _ in range(2):
            left = keep(left.join(points_of(left).where(F.col("own") >= votes), "node", "left_semi"), "media-left")
            left = keep(several(left), "media-left")
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        dealt = left.join(points.select("node", "k", F.col("p.bits").alias("bits")), ["node", "k"]).withColumn("own", F.pmod(F.xxhash64("node", "k"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        dealt = dealt.select("v", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), F.struct("node", "k", "component", (F.col("own") > F.col("other")).alias("side"), "bits").alias("member"))
        dealt = dealt.groupBy("v", "lo", "hi").agg(F.collect_list("member").alias("members")).select((F.col("lo") == F.col("hi")).alias("one"), "members")
        found = keep(dealt.mapInArrow(_compare, "node bigint, k int, first bigint, fk int"), "media-pairs")
        both = again.union(paired(found)).groupBy("node", "first").agg(F.array_distinct(F.flatten(F.collect_list("m"))).alias("m"))
        both = keep(enough(both), "media-candidates")
        tried = agreed(keep(best_of_each(both).select("node", "first", few_points.alias("m")), "media-best"))
        links = links.union(tried).union(rest_linked(apart(both, tried)))
        labels = keep(connected_components(links, "media"), "media-groups")
    groups = own.join(labels.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left").select("content", "least", "corners", F.coalesce("component", "node").alias("component"))
    groups = groups.join(groups.groupBy("component").agg(F.min("least").alias("group_id")), "component").select(F.col("content").alias("__content"), "corners", "group_id")
    result = described.select("media_id", "content").join(groups, F.col("content") == F.col("__content"), "left")
    result = result.select("media_id", F.coalesce("corners", F.lit(0)).alias("n_corners"), F.when(F.col("media_id").isNotNull(), F.coalesce("group_id", "media_id")).alias("group_id"))
    result, _ = materialize(result, "media-result")
    for path in stored:
        remove_table(spark, path)
    return result


def draw_mosaic(vector: list[float], cell: int = 10):
    """A grey mosaic of a vector's values, as square as they allow: media for tables that only have vectors.

    A descriptor sees several cells, as what is around one junction of large cells looks alike in many mosaics, and an image of 64 values is large
    enough for all scales.
    """
    import numpy as np

    v = np.nan_to_num(np.array([0.0 if x is None else x for x in vector], dtype=float))
    side = max(1, int(np.ceil(np.sqrt(len(v)))))
    low, high = (v.min(), v.max()) if len(v) else (0, 0)
    grid = np.zeros(side * side)
    grid[: len(v)] = (v - low) / (high - low) * 235 + 10 if high > low else 128
    return np.kron(grid.reshape(side, side), np.ones((cell, cell)))


def draw_waves(vector: list[float], size: int = 80):
    """A grey texture of a vector's values, each the weight of a wave along and across: what is around a corner depends on all values.

    Corners of a mosaic look alike in all mosaics, and tell little of which it is.
    """
    import numpy as np

    v = np.nan_to_num(np.array([0.0 if x is None else x for x in vector], dtype=float))
    side = max(1, int(np.ceil(np.sqrt(len(v)))))
    weights = np.zeros(side * side)
    weights[: len(v)] = v
    k = np.arange(side)
    waves = np.cos(1.7 * np.pi * np.outer(k + 1, (np.arange(size) + 0.5) / size) + k[:, None])
    drawn = waves.T @ weights.reshape(side, side) @ waves
    low, high = drawn.min(), drawn.max()
    return (drawn - low) / (high - low) * 235 + 10 if high > low else np.full((size, size), 128.0)


#: Added to the id of an image for that of its edited copy.
EDITED = 1 << 40


def edit(image, how: int, seed: int = 0):
    """An edited copy: cropped by an eighth at each side, with noise, darker, or turned by a quarter."""
    import numpy as np

    h, w = image.shape
    if how == 0:
        return image[h // 8 : h - h // 8, w // 8 : w - w // 8]
    if how == 1:
        return np.clip(image + np.random.default_rng(seed).normal(0, 6, image.shape), 0, 255)
    return np.clip(image * 0.8 + 20, 0, 255) if how == 2 else np.rot90(image)


def mosaics(vectors: DataFrame, id_col: str, vector_col: str, edits: int = 0, draw=draw_mosaic) -> DataFrame:
    """(media_id, image): each vector drawn as an image by ``draw``; a null vector is a null image.

    With ``edits``, of each so many ids four in turn also have a copy by :func:`edit`, whose id is larger by EDITED.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            ids, drawn = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                image = None if v is None else draw(v)
                ids.append(i)
                drawn.append(None if v is None else encode(image))
                if edits and i is not None and v is not None and i % edits < 4:
                    ids.append(i + EDITED)
                    drawn.append(encode(edit(image, i % edits, i)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(drawn, pa.binary())], names=["media_id", "image"])

    return vectors.select(F.col(id_col).cast("bigint"), F.col(vector_col)).mapInArrow(run, "media_id bigint, image binary")
