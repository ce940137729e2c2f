"""SimHash components, near-duplicate groups and line templates against brute force."""

import random

import pytest

from vacantia.llm.common import connected_components, join_frequent
from vacantia.llm import line_templates
from vacantia.llm.line_templates import dedup_lines, file_line, line_id, masked, template_links, variable_fields
from vacantia.llm.near_duplicates import block_pairs, drop_near_duplicates, near_duplicate_groups, shingle_prefix, similarity
from vacantia.llm.simhash import fingerprint, link_fingerprints, simhash_components


def union(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def letters(number):
    """A word without digits for a number."""
    return "".join("bcdfghjkmn"[int(d)] for d in str(number))


def words(draw, n, pool=4000):
    return [f"{draw.choice('pqrstv')}{letters(draw.randrange(pool))}" for _ in range(n)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), *((100 + k, 101 + k) for k in range(40)), *((500, 501 + k) for k in range(50))]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "t").collect()}
    whole = union({x for e in edges for x in e}, edges)
    whole.pop(5)
    assert got == whole
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "t").count() == 0


def test_fingerprint_is_the_vote_over_shingles():
    import xxhash

    assert fingerprint([], 3) == 0
    w = [b"a", b"b", b"c", b"a", b"b", b"c", b"d"]
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(5)]
    assert fingerprint(w, 3) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > 5)
    assert fingerprint([b"x", b"y"], 3) == sum(1 << b for b in range(64) if xxhash.xxh64_intdigest(b"x y", 42) >> b & 1)


@pytest.mark.parametrize("hot", [2, 32])
def test_links_join_all_within_distance(spark, hot):
    draw, fps = random.Random(4), set()
    for _ in range(30):
        base = draw.getrandbits(64)
        fps.add(base)
        for _ in range(draw.randint(0, 12)):
            x = base
            for _ in range(draw.randint(0, 2)):
                x ^= 1 << draw.randrange(64)
            fps.add(x)
    fps = {f - (1 << 64) if f >> 63 else f for f in fps}
    near = [(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    links = [tuple(r) for r in link_fingerprints(spark.createDataFrame([(f,) for f in fps], "fp bigint"), 2, hot).collect()]
    assert all(tuple(sorted(x)) in set(near) for x in links)
    assert union(fps, links) == union(fps, near)


def test_simhash_components_edge_cases(spark):
    rows = [(3, "A b c d", "k"), (1, "a B c d", "k"), (2, None, None), (7, "", "k"), (None, " \n", "k"), (9, "x " * 50_000, "k"), (9, "x " * 50_000, "k"), (4, "Ünï", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_components(docs).collect()), key=str)
    assert len(got) == len(rows)
    assert {c for i, f, c in got if i in (1, 3)} == {1} and {c for i, f, c in got if f == "0" * 16} == {2}
    assert simhash_components(docs.limit(0)).count() == 0


def test_near_duplicates(spark):
    draw, rows, base = random.Random(5), [], None
    for k in range(60):
        base = words(draw, draw.randint(60, 300))
        rows.append((10 * k, " ".join(base)))
        for c in range(1, k % 4):
            copy = list(base)
            for _ in range(c * len(base) // 150):
                copy[draw.randrange(len(copy))] = "edited"
            rows.append((10 * k + c, " ".join(copy)))
    rows += [(1001, None), (1002, ""), (1003, "same text"), (1004, "same text"), (None, "same text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["group"] for r in near_duplicate_groups(docs).collect() if r["doc_id"] is not None}
    known = [(i, t or "") for i, t in rows if i is not None]
    pairs = [(a, b) for a, x in known for b, y in known if a < b and abs(a - b) < 10 and similarity(x, y) >= 0.8]
    assert got == union([i for i, _ in known], pairs)
    kept = {r["doc_id"] for r in drop_near_duplicates(docs).collect()}
    assert kept == {g for g in got.values()} | {None}
    assert drop_near_duplicates(docs.limit(0)).count() == 0


def test_line_templates(spark):
    draw = random.Random(7)
    shared = [" ".join(words(draw, 60)) for _ in range(5)]
    rows = []
    for k in range(40):
        lines = [" ".join(words(draw, draw.randint(3, 20))) for _ in range(draw.randint(1, 5))]
        if k % 3 == 0:
            line = shared[k % 5].split()
            line[draw.randrange(2, 60)] = f"changed{letters(k)}"
            lines.insert(1, " ".join(line))
        lines.append(f"Page {k} of the long report was printed on day {k * 3}")
        rows.append((k, "\n".join([*lines, "ok"]), k))
    rows += [(50, None, 1), (51, "", 1), (None, rows[0][1], 1), (52, "Page 7 of the long report was printed on day 9", 1), (52, "Page 7 of the long report was printed on day 9", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_lines int")
    names, docs_of = {}, {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if i is not None and line_id(line) is not None:
                names[line_id(line)] = masked(line)
                docs_of.setdefault(line_id(line), set()).add(i)
    alike = [(a, b) for a, x in names.items() for b, y in names.items() if a < b and len(x) == len(y) and x[:2] == y[:2] and sum(p != q for p, q in zip(x, y)) <= variable_fields(len(x))]
    template = union(names, alike)
    first = {}
    for n, t in template.items():
        first[t] = min(first.get(t, 10**9), *docs_of[n])
    many = {t for t in template.values() if len(set().union(*(docs_of[n] for n in names if template[n] == t))) > 1}
    got = sorted(((r["doc_id"], r["text"]) for r in dedup_lines(docs).collect()), key=str)
    want = []
    for i, t, _ in rows:
        keep = lambda x: i is None or (n := line_id(x)) is None or template[n] not in many or first[template[n]] == i
        want.append((i, None if t is None else "\n".join(filter(keep, t.split("\n")))))
    assert got == sorted(want, key=str)
    assert dedup_lines(docs.limit(0)).count() == 0


def exact_links(known, threshold=0.8):
    """All pairs of (id, text) at the similarity, by brute force over shingle sets."""
    sets = [(i, {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))}) for i, t in known for w in [t.lower().split()]]
    return [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if len(x & y) >= threshold * len(x | y)]


def test_near_duplicates_near_the_threshold(spark):
    draw = random.Random(16)
    rows = []
    for k in range(60):
        n = (12, 30, 100, 400)[k % 4]
        base = words(draw, n)
        new = max(1, int(n * (0.1 if k % 2 else 0.19)))
        start = draw.randrange(n - new)
        edits = [[*base, *words(draw, new)], [*base[:start], *words(draw, n // 12), *base[start + n // 12 :]], base[new:], base[:-new]]
        rows += [(10 * k, " ".join(base)), *((10 * k + 1 + i, " ".join(e)) for i, e in enumerate(edits))]
    links = exact_links(rows)
    got = {r["doc_id"]: r["group"] for r in near_duplicate_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(links) > 100 and got == union([i for i, _ in rows], links)


def test_near_duplicates_of_large_keys(spark):
    draw = random.Random(18)
    base = words(draw, 100)
    rows = []
    for k in range(150):  # copies that are near in chains only, among unlike ones that share their keys
        copy = list(base) if k % 2 or not rows else rows[-1][1].split()
        for _ in range((5, 2, 7, 2)[k % 4]):
            copy[draw.randrange(100)] = f"edit{k}x{draw.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    links = exact_links(rows)
    want = union([i for i, _ in rows], links)
    assert 1 < len(set(want.values())) < 150
    assert {r["doc_id"]: r["group"] for r in near_duplicate_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} == want


def test_block_pairs_lose_none():
    draw = random.Random(19)
    base = words(draw, 60)
    texts = [" ".join(base[:k] + words(draw, 60 - k) if k % 2 else base[60 - k :] + words(draw, 60 - k)) for k in range(30, 60)]
    members = [{"node": i, "component": i, "n": n, "pos": 0, "side": i > 14, "map": m} for i, (n, _, m) in enumerate(map(shingle_prefix, texts))]
    links = exact_links(list(enumerate(texts)))
    assert links and set(links) <= set(block_pairs(members, True, 0.8)) and len(block_pairs(members, True, 0.8)) < 2 * len(links) + 20
    assert {(a, b) for a, b in links if a <= 14 < b} <= set(block_pairs(members, False, 0.8))


def test_many_templates_in_one_key(spark):
    draw = random.Random(20)
    rows = []
    for k in range(700):  # more lines of one key than a block holds
        a, b = ("".join(draw.choices("bcdfghjk", k=12)) for _ in range(2))
        rows += [(2 * k, f"shared lead {a} fixed {b} one tail here"), (2 * k + 1, f"shared lead {a} fixed {b}x one tail here")]
    got = {r["doc_id"]: r["n_dropped"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum(got.values()) == 700 and all(got[2 * k + 1] == 1 for k in range(700))


def brute_templates(lines):
    """Template links of all pairs of token lists by name."""
    return [(a, b) for a, x in lines.items() for b, y in lines.items() if a < b and len(x) == len(y) and x[:2] == y[:2] and sum(p != q for p, q in zip(x, y)) <= variable_fields(len(x))]


@pytest.mark.parametrize(("cold", "most_open"), [(2, 5), (2, 24), (64, 24)])
def test_template_links_are_exact(spark, monkeypatch, cold, most_open):
    monkeypatch.setattr(line_templates, "OPEN", most_open)
    draw, lines = random.Random(21), []
    for k in range(60):
        n = (6, 8, 11, 12, 17, 40)[k % 6]
        base = ["shared", "lead", *words(draw, n - 2, 3 if k % 5 else 4000)]
        for _ in range(draw.randint(2, 8)):
            line = list(base)
            for _ in range(draw.randint(0, 2)):
                line[draw.randrange(n)] = f"new{letters(draw.randrange(3 * n))}"
            lines.append(line)
    lines += [["shared", "lead", "only", "three", "x"], ["shared", "lead", "only", "three", "y"]]
    named = {line_id(" ".join(x)): masked(" ".join(x)) for x in lines}
    rows = [(i, *file_line(x)) for i, x in named.items() if variable_fields(len(x))]
    forms = spark.createDataFrame([*rows, *rows[:9]], "line bigint, keys array<bigint>, form binary")
    links, brute = [tuple(r) for r in template_links(forms, cold).collect()], brute_templates(named)
    assert len(brute) > 50 and {tuple(sorted(x)) for x in links} <= set(brute)
    assert union(named, links) == union(named, brute)


def test_tokens_are_hashed_once_a_line_shares_a_key(spark, monkeypatch):
    stored, materialize = {}, line_templates.materialize

    def noted(table, label, *rows):
        kept = materialize(table, label, *rows)
        if label in ("lines", "line-forms"):
            stored[label] = dict(table.dtypes), kept[0].count()
        return kept

    monkeypatch.setattr(line_templates, "materialize", noted)
    draw, rows = random.Random(25), []
    for k in range(200):  # one in ten recurs but for a word
        x = words(draw, 14)
        rows.append((k, " ".join(x) + ("\n\n7 lines " if k % 3 else "")))
        rows += [(1000 + k, " ".join([*x[:9], "other", *x[10:]]))] * (k % 10 == 0)
    rows += [(3000, ""), (3001, None), (None, rows[0][1])]
    got = {r["doc_id"]: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert stored["lines"][0]["form"] == "string" and stored["line-forms"] == ({"line": "bigint", "form": "binary"}, 40)
    for i, t in rows:
        gone = i is not None and 1000 <= i < 3000
        assert (got[i]["n_lines"], got[i]["n_dropped"], got[i]["text"]) == (0 if t is None else t.count("\n") + 1, int(gone), "" if gone else t)


def test_templates_among_unlike_lines_of_a_leaf(spark):
    draw = random.Random(22)
    name = lambda: "".join(draw.choices("bcdfghjkmnp", k=9))
    rows = [(k, f"Posted by admin on {name()} {name()}") for k in range(300)]
    for k in range(40):
        x = name()
        rows += [(1000 + k, f"Posted by admin on {x} {name()}"), (2000 + k, f"Posted by admin on {x} {name()}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in dedup_lines(docs).collect()}
    assert all(got[i] == (i >= 2000) for i, _ in rows)
    both = {r["doc_id"]: r["n_dropped"] for r in dedup_lines(docs, keep_first=False).collect()}
    assert all(both[i] == (i >= 1000) for i, _ in rows)


def test_short_lines_and_lines_without_words(spark):
    same = "字" * 60
    rows = [(1, f"ok\n{same}\n1 2 3\n{same}7"), (2, f"ok\n{same}\n4 5 6\n{same}8"), (3, "ok then\n1 2 3")]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: rows[0][1], 2: f"ok\n4 5 6\n{same}8", 3: "ok then"}


def test_frequent_keys_are_joined_alike(spark):
    left = spark.createDataFrame([(k % 7 if k % 3 else 99, k) for k in range(3000)], "key bigint, x bigint")
    right = spark.createDataFrame([(99, 1000, "a"), (1, 280, "b"), (5, 1, "c"), (500, 1, "d")], "key bigint, n bigint, y string")
    assert sorted(map(tuple, join_frequent(left, right, "key").collect())) == sorted(map(tuple, left.join(right, "key").collect()))


@pytest.mark.parametrize("most", [0, 500_000])
def test_keys_are_counted_without_sketches(spark, monkeypatch, most):
    monkeypatch.setattr(line_templates, "BROADCAST_LINES", most)
    levels, plans, materialize = [], [], line_templates.materialize

    def stored(table, label, *rows):
        plans.append(table._jdf.queryExecution().optimizedPlan().toString())
        kept = materialize(table, label, *rows)
        if label == "line-level" and "n" in table.columns:
            levels.append([tuple(r) for r in kept[0].select("key", "line", "n").collect()])
        return kept

    monkeypatch.setattr(line_templates, "materialize", stored)
    draw = random.Random(23)
    lines = [["shared", "lead", *words(draw, 3, 5), "the", "same", "tail"] for _ in range(150)]
    rows = [(line_id(" ".join(x)), *file_line(x)) for x in lines]
    template_links(spark.createDataFrame([*rows, *rows], "line bigint, keys array<bigint>, form binary"), 8).count()
    assert levels and levels[0] and not any("approx_count_distinct" in x for x in plans)
    for level in levels:
        assert all(n == len({b for k, b, _ in level if k == key}) for key, _, n in level)


def test_the_pipeline_links_by_simhash(spark):
    import corpus_pipeline

    draw, rows = random.Random(24), []
    for k in range(12):
        phrase, tail = words(draw, 13), words(draw, 60)
        rows.append((10 * k, " ".join([*phrase * 40, *tail])))  # fingerprints of the phrase, shingle sets mostly of the tails
        rows.append((10 * k + 1, " ".join([*phrase * 40, *words(draw, 60)])))
        rows.append((10 * k + 2, " ".join([*phrase * 40, *tail[:54]])))
    rows += [(500, ""), (501, None), (502, "a b c d e f"), (None, "a b c d e f")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars int")
    by_print = {r["doc_id"]: r["component_id"] for r in simhash_components(docs).collect() if r["doc_id"] is not None}
    texts = [(i, t or "") for i, t in rows if i is not None]
    want = union([i for i, _ in texts], [*by_print.items(), *exact_links(texts)])
    assert sum(want[10 * k + 1] == 10 * k for k in range(12)) >= 6 and want != union([i for i, _ in texts], exact_links(texts))
    assert {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {*want.values(), None}
