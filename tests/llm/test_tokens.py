"""Token counts, token store and packing against the libraries and brute force."""

import bisect
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.llm import packing
from vacantia.llm.packing import build_sequences, longest_pieces, pack_documents, sweep_range
from vacantia.llm.token_counts import count_tokens
from vacantia.llm.token_ids import read_document, read_token_store, write_token_store
from vacantia.llm.tokenizing import ByteEncoder, PieceCounter, tokenizer_path

ODD = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "a", "bc", "the", "The", "é", "ß", "漢字", "12", "!", "?!", "'s", "▁", "　", "😀", "<s>", "</s>", "<|endoftext|>", "\x00", "\x1c", "\x85", "​"]
ROWS = [(3, "one two three", "x"), (1, None, "x"), (2, "", "x"), (None, "no id here", "x"), (5, "word " * 3000, "x"), (5, "word " * 3000, "x"), (4, "a\n\nb  c<|endoftext|>", None)]
SCHEMA = "doc_id bigint, text string, n_tokens string"


@pytest.fixture(scope="module")
def encoder():
    return ByteEncoder(tokenizer_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def counter():
    return PieceCounter(tokenizer_path("piece_bpe_32k.model"))


def test_pieces_equal_the_libraries(encoder, counter):
    draw = random.Random(1)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    assert encoder.encode(texts) == encoder.whole(texts)
    assert counter.count(texts) == [len(x) for x in counter.sp.encode(texts)]


def test_every_code_point_has_the_librarys_ids(encoder):
    assert encoder.merger is not None
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 1 << 16):
        texts = ["".join(f"a{c}b {c} 1{c}{c}." for c in points[k : k + 64]) for k in range(low, min(low + (1 << 16), len(points)), 64)]
        assert encoder.encode(texts) == encoder.whole(texts)
    long = [" " * 50_000 + "x", "a" * 30_000, "\n \t" * 30_000, "ab" * 20_000 + "<|endoftext|>"]
    assert encoder.encode(long) == encoder.whole(long)


def test_whole_tokens_are_proven(counter):
    words = list(counter.whole_tokens)[:500]
    assert len(counter.whole_tokens) > 10_000 and all(len(x) == 1 for x in counter.sp.encode(words))


def test_count_tokens(spark, counter):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(map(tuple, count_tokens(docs, "piece_bpe_32k.model", limit=100).collect()), key=str)
    assert got == sorted(((i, len((t or "").encode()), n := len(counter.sp.encode(t or "")), n > 100) for i, t, _ in ROWS), key=str)
    assert count_tokens(docs.limit(0), "piece_bpe_32k.model").count() == 0


def test_store_round_trip(spark, encoder, tmp_path):
    folder = f"file://{tmp_path}/store"
    write_token_store(spark.createDataFrame(ROWS, SCHEMA).repartition(3), folder, "byte_bpe_50k.json", end_id=0)
    got = sorted(read_token_store(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 5]
    texts, at = {i: t for i, t, _ in ROWS}, 0
    for r in got:
        ids = np.append(np.frombuffer(encoder.whole([texts[r["doc_id"]] or ""])[0], "<u4"), 0).astype("<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) == (at, len(ids), zlib.crc32(ids.tobytes()), ids.tolist())
        at += len(ids)
    assert read_document(spark, folder, 3)[-1] == 0 and read_document(spark, folder, 9) is None
    write_token_store(spark.createDataFrame([], SCHEMA), folder + "2", "byte_bpe_50k.json")
    assert read_token_store(spark, folder + "2").count() == 0


def best_fit(pieces, gaps):
    """Sizes of the gaps that pieces get, the longest first, each the smallest that is left and holds it."""
    free, got = sorted(gaps), []
    for p in sorted(pieces, reverse=True):
        k = bisect.bisect_left(free, p)
        got.append((p, free.pop(k) if k < len(free) else None))
    return got


def test_a_range_is_swept_by_best_fit():
    draw = random.Random(2)
    for _ in range(300):
        pieces, gaps = ([draw.randint(1, 12) for _ in range(draw.randint(0, 15))] for _ in range(2))
        events = sorted([(-g, False) for g in gaps] + [(-p, True) for p in pieces])
        size, piece = np.array([-e[0] for e in events], dtype="int64"), np.array([e[1] for e in events], dtype=bool)
        taken = sweep_range(piece, size)
        got = [(int(size[k]), int(size[t]) if t >= 0 else None) for k, t in enumerate(taken) if piece[k]]
        assert sorted(got, key=str) == sorted(best_fit(pieces, gaps), key=str)


@pytest.mark.parametrize("rows", [7, 20_000])
def test_sweeps_across_ranges_are_best_fit(spark, monkeypatch, rows):
    monkeypatch.setattr(packing, "RANGE_ROWS", rows)
    draw = random.Random(3)
    pieces, gaps = [draw.randint(20, 40) for _ in range(90)], [draw.randint(10, 39) for _ in range(80)]
    left = spark.createDataFrame(list(enumerate(pieces)), "key bigint, length bigint")
    table, _ = packing.sweep(left, spark.createDataFrame(list(enumerate(gaps)), "seq bigint, gap bigint"), 40, 20, len(pieces), len(gaps))
    rows = table.collect()
    got = [(r["length"], None if r["seq"] is None else gaps[r["seq"]]) for r in rows]
    assert sorted(got, key=str) == sorted(best_fit(pieces, [g for g in gaps if g >= 20]), key=str)
    assert len({r["seq"] for r in rows if r["seq"] is not None}) == sum(r["seq"] is not None for r in rows)


@pytest.mark.parametrize("rows", [7, 20_000])
def test_slots_of_a_gap_are_not_rows(spark, monkeypatch, rows):
    monkeypatch.setattr(packing, "RANGE_ROWS", rows)
    draw = random.Random(9)
    pieces, gaps = [draw.randint(3, 10) for _ in range(200)], [draw.choice([4, 9, 30, 95, 100]) for _ in range(30)]
    events, materialize = [], packing.materialize

    def stored(table, label, rows=None):
        if label == "swept":
            events.append(table.count())
        return materialize(table, label, rows)

    monkeypatch.setattr(packing, "materialize", stored)
    left = spark.createDataFrame(list(enumerate(pieces)), "key bigint, length bigint")
    table, _ = packing.sweep(left, spark.createDataFrame(list(enumerate(gaps)), "seq bigint, gap bigint"), 10, 3, len(pieces), len(gaps))
    got = table.collect()
    slots = [n for g in gaps if g >= 3 for n in [max(1, min(g // 10, -(-2 * len(pieces) // len(gaps))))]]
    sizes = [x for g, n in zip(gaps, slots, strict=True) for x in [*[10] * (n - 1), g - 10 * (n - 1)]]
    best = Counter(p for p, g in best_fit(pieces, sizes) if g is not None)
    assert Counter(r["length"] for r in got if r["seq"] is not None) == best and sorted(r["length"] for r in got) == sorted(pieces)
    taken = [(r["seq"], r["slot"]) for r in got if r["seq"] is not None]
    assert len(set(taken)) == len(taken) and all(s < slots[q] for q, s in taken)
    used = Counter()
    for r in got:
        used[r["seq"]] += r["length"]
    assert all(used[q] <= g for q, g in enumerate(gaps))
    assert events[0] <= len(pieces) + 2 * len(gaps) < len(pieces) + len(sizes)


def test_longest_pieces(spark):
    draw = random.Random(4)
    lengths = [draw.randint(1, 5) for _ in range(500)]
    left = spark.createDataFrame(list(enumerate(lengths)), "key bigint, length bigint")
    for n in (1, 99, 250, 499, 500):
        got = sorted(r["length"] for r in left.where(longest_pieces(left, Counter(lengths), n)).collect())
        assert got == sorted(lengths)[-n:]


def check_packing(rows, docs, encoder, size):
    """Rows against the library's ids: every piece in its place, sequences without gaps, none too long."""
    ids = {i: np.append(np.frombuffer(encoder.whole([t or ""])[0], "<u4"), 2).astype("<u4") for i, t in docs}
    spans, pieces = {}, {}
    for r in rows:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
    for found in spans.values():
        assert [o for o, _ in sorted(found)] == [0, *np.cumsum([n for _, n in sorted(found)])[:-1]] and sum(n for _, n in found) <= size
    for i, own in pieces.items():
        for piece, start in {(r["piece"], r["start"]) for r in own}:
            n = len(ids[i]) % size or size
            length = n if piece == 0 else size
            assert start == (0 if piece == 0 else n + (piece - 1) * size)
            assert {(r["length"], r["ids_crc32"]) for r in own if r["piece"] == piece} == {(length, zlib.crc32(ids[i][start : start + length].tobytes()))}
    return ids, spans


def test_packing(spark, encoder):
    draw = random.Random(5)
    many = [(100 + k, "w " * draw.choice([0, 3, 9, 31, 32, 33, 64, 127, draw.randint(0, 200)]), "z") for k in range(300)]
    rows = [*ROWS, (6, ROWS[4][1] + "x", "y"), *many, *many[:40], (99, many[7][1], None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    packed = pack_documents(docs, "byte_bpe_50k.json", size=64, end_id=2)
    got = packed.collect()
    ids, spans = check_packing(got, [r[:2] for r in rows], encoder, 64)
    total = sum(len(ids[i]) for i, _, _ in rows)
    open_gaps = []
    for n in sorted((r["length"] for r in got), reverse=True):  # one by one
        k = bisect.bisect_left(open_gaps, n)
        bisect.insort(open_gaps, (open_gaps.pop(k) if k < len(open_gaps) else 64) - n)
    assert sum(r["length"] for r in got) == total and len(spans) <= len(open_gaps) * 1.02 + 1
    whole = build_sequences(docs, packed, "byte_bpe_50k.json", 64, 2).collect()
    assert {r["sequence_id"]: len(r["ids"]) for r in whole} == {s: sum(n for _, n in x) for s, x in spans.items()}
    place = {(r["sequence_id"], r["offset"]): ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tolist() for r in got}
    assert all(r["ids"][o : o + len(x)] == x for r in whole for (s, o), x in place.items() if s == r["sequence_id"])
    assert pack_documents(docs.limit(0), "byte_bpe_50k.json").count() == 0
    one = pack_documents(spark.createDataFrame([(1, "")], "doc_id bigint, text string"), "byte_bpe_50k.json", size=1).collect()
    assert [(r["length"], r["offset"]) for r in one] == [(1, 0)]


def test_the_pipeline_ends_in_whole_sequences(spark, encoder):
    import corpus_pipeline

    draw = random.Random(6)
    rows = [(k, "w " * draw.choice([0, 3, 400, 1023, 1024, 2500, draw.randint(0, 900)]), "en", "web") for k in range(60)]
    rows += [*rows[:20], *rows[:20], (99, None, "en", "web"), (None, "no id", "en", "web"), (None, "nor this", "en", "web"), (7, "another text of the same id", "en", "web")]  # as mixing repeats them
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    got = corpus_pipeline.best_fit_packing(spark, docs, "").collect()
    ids = Counter((i, tuple(np.append(np.frombuffer(encoder.whole([t or ""])[0], "<u4"), 2).tolist())) for i, t, *_ in rows)
    want, have = Counter(), Counter()
    for (i, x), n in ids.items():
        cuts = [0, *range(len(x) % 1024 or 1024, len(x) + 1, 1024)]
        for piece, (low, high) in enumerate(zip(cuts, cuts[1:])):
            want[i, piece, low, x[low:high]] += n
    for r in got:
        assert len(r["ids"]) <= 1024 and [p["offset"] for p in r["pieces"]] == [0, *np.cumsum([p["length"] for p in r["pieces"]])[:-1]]
        assert sum(p["length"] for p in r["pieces"]) == len(r["ids"])
        for p in r["pieces"]:
            have[p["doc_id"], p["piece"], p["start"], tuple(r["ids"][p["offset"] : p["offset"] + p["length"]])] += 1
    assert have == want and len({r["sequence_id"] for r in got}) == len(got)
    assert corpus_pipeline.best_fit_packing(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize(("end_id", "width"), [(2, 2), (70_000, 4)])
def test_ids_are_stored_and_shuffled_in_two_bytes(spark, encoder, monkeypatch, end_id, width):
    sizes, materialize = [], packing.materialize

    def stored(table, label, rows=None):
        kept = materialize(table, label, rows)
        if label == "pieces":
            sizes.extend(map(tuple, kept[0].select("length", F.octet_length(F.col("ids").cast("binary"))).collect()))
        return kept

    monkeypatch.setattr(packing, "materialize", stored)
    rows = [(k, "a word " * (3 * k) + "w " * 40, "z") for k in range(30)]
    got = packing.pack_sequences(spark.createDataFrame(rows, SCHEMA), "byte_bpe_50k.json", size=64, end_id=end_id).collect()
    have = {(p["doc_id"], p["start"]): r["ids"][p["offset"] : p["offset"] + p["length"]] for r in got for p in r["pieces"]}
    whole = {i: [*np.frombuffer(encoder.whole([t])[0], "<u4").tolist(), end_id] for i, t, _ in rows}
    assert {i: sum((x for (d, _), x in sorted(have.items()) if d == i), []) for i in whole} == whole
    # a piece with the wide id has four bytes an id, all others two
    assert {size / length for length, size in sizes} == {2, width}


@pytest.mark.parametrize("seed", range(40))
def test_plans_are_best_fit_by_falling_length(seed):
    draw = random.Random(seed)
    size = draw.choice([1, 7, 40, 100])
    lengths = [min(size, draw.choice([1, 3, draw.randint(1, size)])) for _ in range(draw.choice([0, 1, 30, 400]))]
    plan = packing.plan_sequences(Counter(lengths), size)
    got, held = [], Counter()
    for n, own in plan:
        assert n > 0 and sum(x * k for x, k in own) <= size
        got += [size - sum(x * k for x, k in own)] * n
        held.update({x: n * k for x, k in own})
    gaps = []
    for x in sorted(lengths, reverse=True):  # one by one
        k = bisect.bisect_left(gaps, x)
        bisect.insort(gaps, (gaps.pop(k) if k < len(gaps) else size) - x)
    assert sorted(got) == gaps and held == Counter(lengths) and len(plan) <= 3 * len(set(lengths))


@pytest.mark.parametrize(("longest", "tables"), [(8192, 3), (63, 1000)])
def test_packing_takes_few_tables(spark, encoder, monkeypatch, longest, tables):
    monkeypatch.setattr(packing, "PLANNED", longest)
    monkeypatch.setattr(packing, "RANGE_ROWS", 300)
    draw, labels, materialize = random.Random(31), [], packing.materialize

    def stored(table, label, rows=None):
        labels.append(label)
        return materialize(table, label, rows)

    monkeypatch.setattr(packing, "materialize", stored)
    rows = [(k, "w " * draw.choice([3, 3, 5, 9, draw.randint(0, 70)]), "z") for k in range(1500)]
    got = pack_documents(spark.createDataFrame(rows, SCHEMA), "byte_bpe_50k.json", size=64, end_id=2).collect()
    ids, spans = check_packing(got, [r[:2] for r in rows], encoder, 64)
    assert len(labels) <= tables and sum(r["length"] for r in got) == sum(map(len, ids.values()))
    assert sorted((r["doc_id"], r["piece"]) for r in got) == sorted((i, p) for i, x in ids.items() for p in range(-(-len(x) // 64)))
    assert len(spans) <= -(-sum(map(len, ids.values())) // 64) * (1.02 if longest > 64 else 1.15) + 1
