"""Toxicity, quality, mixing, fingerprints and media."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vacantia.llm.fingerprints import containment, edited_fingerprints, fingerprints, merge
from vacantia.llm import media
from vacantia.llm.media import EDITED, decode, describe, draw_mosaic, draw_waves, encode, media_copies, mosaics
from vacantia.llm.mixing import mix
from vacantia.llm.quality import compile_score, fit_rules, quality
from vacantia.llm.toxicity import toxicity

EDGE = [(None, "no id", 5), (900001, None, 5), (900002, "", 5), (900003, "long " * 60_000, 5), (900003, "long " * 60_000, 5)]


@pytest.fixture(scope="module")
def corpus(spark):
    draw, rows, labels = random.Random(3), [], []
    for i in range(800):
        text = [f"w{draw.randrange(500)}" for _ in range(draw.randint(20, 60))]
        bad, low = i % 5 == 0, i % 7 == 0
        if bad:
            text[draw.randrange(len(text))] = draw.choice(["awfulness", "awfully", "awful,"])
        if low:
            text = [w + "***" for w in text]
        rows.append((i, " ".join(text), 0))
        labels.append((i, int(bad), int(not low)))
    docs = spark.createDataFrame(rows + EDGE, "doc_id bigint, text string, score int")
    return docs.cache(), spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (5, 0, 1)], "doc_id bigint, toxic int, quality int").cache()


def test_the_pipeline_sends_small_batches(spark, corpus):
    import corpus_pipeline

    key, sizes = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    rows = spark.range(5000, numPartitions=1)
    try:
        for stage in (corpus_pipeline.toxicity_filter, corpus_pipeline.line_dedup, corpus_pipeline.near_dedup):
            spark.conf.set(key, 10_000)
            try:
                stage(spark, spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars int"), "/root/testdata/sf0.001")
            finally:
                sizes += [r[0] for r in rows.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in bs), "n bigint").collect()]
    finally:
        spark.conf.unset(key)
    assert len(sizes) == 15 and max(sizes) == 1000


def test_line_dedup_frees_the_word_table(monkeypatch):
    from vacantia.llm import common, toxicity as module

    kept, freed = common._OWNER[:], []
    monkeypatch.setattr(common, "release", lambda: freed.append(not module._CACHE))
    try:
        module.features("some words to keep")
        assert module._CACHE
        common.claim("lines", lambda: None)
        assert freed[-1] and common._OWNER[0][0] == "lines"
    finally:
        common._OWNER[:] = kept


@pytest.mark.parametrize(("run", "label", "folds", "out"), [(toxicity, "toxic", 4, 2), (quality, "quality", 5, 0)])
def test_classifiers_on_the_held_out_fold(corpus, run, label, folds, out):
    import zlib

    docs, labels = corpus
    got = run(docs, labels, label, folds=folds, out=out).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    truth = {r["doc_id"]: r[label] for r in labels.where(f"doc_id is not null and {label} is not null").collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % folds == out]
    assert np.mean([p == t for p, t in held]) > 0.95
    assert run(docs.limit(0), labels, label).count() == 0
    assert {r["score"] for r in run(docs.limit(3), labels.limit(0), label).collect()} == {0.5}


def test_held_out_labels_are_not_read(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(str, toxicity(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_rules_compile_to_what_they_say(spark):
    draw = np.random.default_rng(1)
    x = draw.random((400, 2))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.5)).astype(float)
    base, rules = fit_rules(x, y, ["a", "b"])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:50]], "a double, b double")
    got = [r[0] for r in df.select(compile_score((base, rules))).collect()]
    want = [1 / (1 + math.exp(-(base + sum(w for rule, w in rules if all((v <= c) == low for n, low, c in rule for v in [row["ab".index(n)]]))))) for row in x[:50]]
    assert np.allclose(got, want) and np.mean((np.array(got) > 0.5) == y[:50]) > 0.95


def test_mixing_rates(spark):
    rows = [(i, "big" if i % 10 else "small", "c") for i in range(3000)] + [(None, None, "c"), (1, "big", "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, cdf string")
    got = mix(docs, {"big": 1.0, "small": 3.0}, total=4000).collect()
    n = sum(r["source"] == "small" for r in got)
    assert abs(n - 3000) < 5 * math.sqrt(3000) and abs(len(got) - n - 1000) < 5 * math.sqrt(1000) and not any(r["source"] is None for r in got)
    assert [r["shuffle_key"] for r in got] == sorted(r["shuffle_key"] for r in got) and {r["cdf"] for r in got} == {"c"}
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(docs.repartition(7), {"big": 1.0, "small": 3.0}, total=4000).collect()), key=str)
    # the count is the inverted distribution at the document's draw
    u = int(hashlib.md5(b"20:7").hexdigest()[:13], 16) / 2**52
    rate, k, p = 3000 / sum(s == "small" for _, s, _ in rows), 0, math.exp(-3000 / sum(s == "small" for _, s, _ in rows))
    total = p
    while total < u:
        k += 1
        p *= rate / k
        total += p
    assert sum(r["doc_id"] == 20 for r in got) == k
    assert mix(docs.limit(0)).count() == 0


def test_large_rates(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, source string")
    assert abs(mix(docs, total=5000).count() - 5000) < 400


def test_sketches(spark):
    draw = random.Random(8)
    a = [f"x{draw.randrange(10**6)}" for _ in range(4000)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:400])), (3, None), (4, ""), (5, "two words"), (5, "two words"), (None, "q")]
    got = {r["doc_id"]: r for r in fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[3]["sketch"] == [] and len(got[5]["sketch"]) == 1 and abs(len(got[1]["sketch"]) - 1000) < 150
    both = spark.createDataFrame([(got[2]["sketch"], got[1]["sketch"])], "a array<bigint>, b array<bigint>")
    r = both.select(containment(F.col("a"), F.col("b")).alias("in"), containment(F.col("b"), F.col("a")).alias("of"), merge(F.col("a"), F.col("b")).alias("m")).first()
    assert r["in"] == 1 and abs(r["of"] - 0.1) < 0.04 and r["m"] == got[1]["sketch"]


def test_edited_texts(spark):
    draw = random.Random(9)
    rows = [(draw.randrange(10**6), "".join(draw.choice("ab é漢\n") for _ in range(draw.randint(0, 50)))) for _ in range(300)]
    rows = list({i: (i, t) for i, t in rows}.values()) + [(None, "tail")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, sketch int").repartition(5)
    got = {r["doc_id"]: r for r in edited_fingerprints(docs).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (i, t) in enumerate(order):
        n, h = order[(k + 1) % len(order)][1], len(t) // 2
        want = t[: len(t) - h] + n[:h]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), hashlib.sha256(want.encode()).hexdigest())
        assert got[i]["near_edited"] == 1 if want == t else 0 <= got[i]["near_edited"] <= 1
    assert edited_fingerprints(docs.limit(0)).count() == 0
    one = edited_fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1


def test_media_copies(spark):
    draw = np.random.default_rng(2)
    pictures = [draw_mosaic(draw.normal(size=64)) for _ in range(12)]
    rows = [(10 * k, encode(p)) for k, p in enumerate(pictures)]
    rows += [(1, encode(pictures[0][7:, 5:75])), (11, encode(np.clip(pictures[1] * 0.8 + 20, 0, 255))), (21, encode(np.rot90(pictures[2]))), (31, encode(pictures[3])), (200, None), (201, b"junk"), (202, b"junk"), (None, encode(pictures[4]))]
    got = {r["media_id"]: r for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()}
    groups = {i: r["group_id"] for i, r in got.items()}
    assert [groups[i] for i in (1, 11, 21, 31)] == [0, 10, 20, 30]
    assert len({groups[10 * k] for k in range(12)}) == 12
    assert (groups[200], groups[201], groups[202], groups[None]) == (200, 201, 201, None)
    assert decode(b"P5 2 2 255\nabcd").shape == (2, 2) and decode(b"P5 9 9 255\na") is None and describe(np.zeros((100, 100))) == []
    assert media_copies(spark.createDataFrame([], "media_id bigint, image binary")).count() == 0


def test_edited_copies_are_found(spark):
    draw = np.random.default_rng(12)
    rows = [(k, draw.normal(size=64).tolist()) for k in range(160)]
    images = mosaics(spark.createDataFrame(rows, "i bigint, v array<double>"), "i", "v", edits=4).cache()
    got = {r["media_id"]: r["group_id"] for r in media_copies(images).collect()}
    assert len(got) == 320 and all(got[k] == k for k in range(160))
    for how in range(4):
        assert np.mean([got[k + EDITED] == k for k in range(how, 160, 4)]) >= 0.9


def test_shared_patches_hide_no_copies(spark):
    draw = np.random.default_rng(13)
    logo, rows = draw_mosaic(draw.normal(size=16), 10), []
    for k in range(60):  # the same patch in a corner of all
        image = draw_mosaic(draw.normal(size=64)).copy()
        image[:30, :30] = logo[:30, :30]
        rows += [(k, encode(image)), (k + 1000, encode(image[:, 6:] * 0.9))]
    got = {r["media_id"]: r["group_id"] for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()}
    assert np.mean([got[k + 1000] == got[k] for k in range(60)]) >= 0.9


def test_large_entries_hide_no_copies(spark, monkeypatch):
    monkeypatch.setattr(media, "PAIRED", 2)  # every entry but those of one pair is large
    draw = np.random.default_rng(14)
    logo, rows = draw_waves(draw.normal(size=64)), []
    for k in range(40):  # unlike images that share a patch with few corners, and of each two copies
        image = draw_waves(draw.normal(size=64))
        image[:34, :34] = logo[:34, :34]
        rows += [(k, encode(image)), (k + 1000, encode(image * 0.9)), (k + 2000, encode(image[:, 5:]))]
    got = {r["media_id"]: r["group_id"] for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()}
    assert all(got[k + 1000] == got[k] == got[k + 2000] for k in range(40)) and len(set(got.values())) >= 30


def test_near_points_of_a_block():
    members = [{"node": i, "k": 0, "component": min(i, 3), "side": i > 2, "bits": [i, 0, 0, -1 if i == 2 else 0]} for i in range(5)]
    assert set(media.near_points(members, True)) == {(a, 0, b, 0) for a in range(5) for b in range(a) if min(a, 3) != min(b, 3) and 2 not in (a, b)}
    assert set(media.near_points(members, False)) == {(a, 0, b, 0) for a in (3, 4) for b in (0, 1)}


def test_one_id_of_two_images_loses_neither(spark):
    draw = np.random.default_rng(15)
    a, b = (draw_waves(draw.normal(size=64)) for _ in range(2))
    rows = [(1, encode(a)), (1, encode(b)), (2, encode(a * 0.9)), (3, encode(b * 0.9))]
    got = sorted((r["media_id"], r["group_id"]) for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1)]


def test_popular_points_are_not_paired_in_vain(spark, monkeypatch):
    draw = np.random.default_rng(17)
    logo, rows, made, materialize = draw_waves(draw.normal(size=64)), [], [], media.materialize
    for k in range(25):  # unlike images that share one corner or so, and of each fifth a copy
        image = draw_waves(draw.normal(size=64))
        image[:27, :27] = logo[:27, :27]
        rows += [(k, encode(image)), *[(k + 1000, encode(image * 0.9))] * (k % 5 == 0)]

    def stored(table, label, *n):
        kept = materialize(table, label, *n)
        if label == "media-pairs":
            made.append(kept[0].count())
        return kept

    monkeypatch.setattr(media, "materialize", stored)
    groups = []
    for paired in (2, 10**6):
        monkeypatch.setattr(media, "PAIRED", paired)
        groups.append(sorted(tuple(r) for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()))
    assert groups[0] == groups[1] and len({g for *_, g in groups[0]}) < len(rows)
    assert sum(made) < 25


def test_a_group_of_copies_is_paired_with_its_head(spark, monkeypatch):
    draw = np.random.default_rng(18)
    picture, made, materialize = draw_waves(draw.normal(size=64)), [], media.materialize
    rows = [(k, encode(picture * (1 - 0.02 * k))) for k in range(24)] + [(k + 100, encode(draw_waves(draw.normal(size=64)))) for k in range(4)]

    def stored(table, label, *n):
        kept = materialize(table, label, *n)
        if label == "media-matches":
            made.append(kept[0].count())
        return kept

    monkeypatch.setattr(media, "materialize", stored)
    got = media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()
    assert {r["media_id"]: r["group_id"] for r in got} == {i: 0 if i < 100 else i for i, _ in rows}
    assert sum(made) < 2 * sum(r["n_corners"] for r in got)  # all pairs would make about twelve times as many


def test_large_groups_apart_are_joined_by_their_best_pairs(spark, monkeypatch):
    draw = np.random.default_rng(29)
    picture, made, materialize = draw_waves(draw.normal(size=64)), {}, media.materialize
    rows = [(i, encode(np.clip(picture + draw.normal(0, 5, picture.shape), 0, 255))) for i in range(40)]

    def stored(df, label, *more):
        table, path = materialize(df, label, *more)
        if label in ("media-candidates", "media-matches"):
            made.setdefault(label, []).append(table.selectExpr("sum(size(m))").first()[0] if "m" in table.columns else table.count())
        return table, path

    monkeypatch.setattr(media, "materialize", stored)
    monkeypatch.setattr(media, "TRIED", 1)  # the first test joins none: all images are groups of their own
    got = {r["group_id"] for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()}
    assert got == {0}
    assert sum(made["media-matches"]) < made["media-candidates"][0]


def test_pairs_of_a_large_group_are_not_labelled_before_it_is_joined(spark, monkeypatch):
    draw = np.random.default_rng(37)
    picture, made, materialize = draw_waves(draw.normal(size=64)), [], media.materialize
    rows = [(i, encode(np.clip(picture + draw.normal(0, 5, picture.shape), 0, 255))) for i in range(24)]

    def stored(df, label, *more):
        made.append(label)
        return materialize(df, label, *more)

    monkeypatch.setattr(media, "materialize", stored)
    monkeypatch.setattr(media, "TRIED", 1)  # the heads join none, the best pair of each image joins all
    got = {r["group_id"] for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()}
    assert got == {0} and "media-apart" not in made


def test_points_that_images_share_are_counted_in_lists():
    draw = np.random.default_rng(3)
    kind = pa.list_(pa.struct([("k", pa.int32()), *((n, pa.list_(t)) for n, t in (("first", pa.int64()), ("fk", pa.int32()), ("beside", pa.int64()), ("other", pa.int32())))]))
    own, rows, want = {i: int(draw.integers(0, 4)) for i in range(60)}, [], {}
    for node in range(30, 40):
        entries, pairs = [], {}
        for k in draw.integers(0, 9, 14).tolist():
            first, fk = draw.integers(0, 12, 6).tolist(), draw.integers(0, 9, 6).tolist()
            entries.append({"k": k, "first": first, "fk": fk, "beside": first, "other": [own[f] for f in first]})
            for f, y in zip(first, fk, strict=True):
                pairs.setdefault(f, set()).add((k, y))
        rows.append((node, node, own[node], entries))
        for f, m in pairs.items():
            want[node, f] = sorted(m), min(len({x[c] for x in m}) for c in (0, 1)), own[node] > 0 and own[f] > 0
    batch = pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int32(), kind))], names=["node", "component", "own", "entries"])
    enough = lambda a, b, m, n: min(len({x[c] for x in m}) + (o if n else 0) for c, o in ((0, own[a]), (1, own[b]))) >= 6
    got = {x[:2]: x[2:] for x in media.shared_points(batch.slice(1), 6, False)}
    assert got == {(a, b): (m, a, b, n) for (a, b), (m, _, n) in want.items() if a > 30 and enough(a, b, m, n)}
    assert any(want[x][1] < 6 for x in got) and len(got) < len(want)
    best = {x[0]: x[1] for x in media.shared_points(batch, 6, True)}
    assert best and best == {a: min((-len(m), b) for (x, b), (m, n, _) in want.items() if x == a and n >= 6)[1] for a in {a for (a, _), (_, n, _) in want.items() if n >= 6}}
    assert not list(media.shared_points(batch.slice(0, 0), 6, True))


def test_pairs_of_small_entries_make_no_rows(spark, monkeypatch):
    draw, plans, materialize = np.random.default_rng(8), [], media.materialize
    pictures = [draw_waves(draw.normal(size=64)) for _ in range(4)]
    rows = [(i + 10 * turn, encode(np.rot90(p, turn))) for i, p in enumerate(pictures) for turn in (0, 1)]

    def stored(df, label, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, label, *more)

    monkeypatch.setattr(media, "materialize", stored)
    got = {r["media_id"]: r["group_id"] for r in media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()}
    assert got == {i: i % 10 for i, _ in rows}
    assert plans and not [p for p in plans if re.search(r"Join \[v#\d+L?\], \[v#\d+L?\], Inner", p)]


@pytest.mark.parametrize("tried", [media.VOTES - 1, media.TRIED])
def test_copies_are_joined_on_few_points_or_on_all(spark, monkeypatch, tried):
    monkeypatch.setattr(media, "TRIED", tried)  # fewer than the votes join none, and all is left to the second round
    draw = np.random.default_rng(19)
    picture, made, materialize = draw_waves(draw.normal(size=64)), [], media.materialize
    rows = [(k, encode(picture * (1 - 0.02 * k))) for k in range(12)] + [(k + 100, encode(draw_waves(draw.normal(size=64)))) for k in range(2)]

    def stored(table, label, *n):
        kept = materialize(table, label, *n)
        if label == "media-matches":
            made.append(kept[0].count())
        return kept

    monkeypatch.setattr(media, "materialize", stored)
    got = media_copies(spark.createDataFrame(rows, "media_id bigint, image binary")).collect()
    assert {r["media_id"]: r["group_id"] for r in got} == {i: 0 if i < 100 else i for i, _ in rows}
    assert tried < media.VOTES or sum(made) <= tried * len(rows)
