"""Operator 6, quality classifier: a sparse rule ensemble over text statistics.

Shallow boosted trees over a bounded sample of labelled documents give conjunctive rules (the paths to their
nodes); a lasso logistic regression weighs the rules and drops most. What is left is compiled into one Column
expression over the statistics, so that scoring is a projection without shuffle, Python or broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .toxicity import crc_fold

#: Documented bound of the labelled sample that is learnt from, by a hash of the ids.
TRAIN_DOCS = 20_000
TREES, DEPTH, RATE, MIN_LEAF = 24, 3, 0.3, 5
PENALTY = 5e-4
THRESHOLD = 0.3

Rule = tuple[tuple[str, bool, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Counts that the features are made of; all zero for the empty text."""
    words = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    lines = F.split(text, "\n")
    return {
        "chars": F.length(text),
        "symbols": F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]+", "")),
        "upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")),
        "digits": F.length(F.regexp_replace(text, r"[^\p{Nd}]+", "")),
        "pipes": F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit(""))),
        "marks": F.length(text) - F.length(F.translate(text, "!?", "")),
        "words": F.when(F.length(F.trim(text)) > 0, F.size(words)).otherwise(0),
        "distinct_words": F.when(F.length(F.trim(text)) > 0, F.size(F.array_distinct(words))).otherwise(0),
        "lines": F.size(lines),
        "distinct_lines": F.size(F.array_distinct(lines)),
    }


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def features() -> dict[str, Column]:
    """Features over the columns of :func:`statistics`."""
    return {
        "log_chars": F.log1p(F.col("chars").cast("double")),
        "log_words": F.log1p(F.col("words").cast("double")),
        "word_length": _share("chars", "words"),
        "symbol_share": _share("symbols", "chars"),
        "upper_share": _share("upper", "chars"),
        "digit_share": _share("digits", "chars"),
        "pipes_per_word": _share("pipes", "words"),
        "marks_per_word": _share("marks", "words"),
        "distinct_share": _share("distinct_words", "words"),
        # a long text repeats words anyway: distinct words against a power of their number
        "distinct_power": F.col("distinct_words") / F.pow(F.greatest(F.col("words"), F.lit(1)).cast("double"), F.lit(0.8)),
        "repeated_lines": 1 - _share("distinct_lines", "lines"),
        "words_per_line": _share("words", "lines"),
    }


def _grow(x, residual, rows, names, depth: int, path: Rule, rules: list[Rule], out) -> None:
    """Grow a regression tree on ``residual``; add each node's path to ``rules`` and its mean to ``out``."""
    import numpy as np

    out[rows] = residual[rows].mean()
    if depth == 0 or len(rows) < 2 * MIN_LEAF:
        return
    best = (1e-9, None, None)
    y = residual[rows]
    base = y.sum() ** 2 / len(y)
    for j in range(x.shape[1]):
        v = x[rows, j]
        order = np.argsort(v, kind="stable")
        s, total = v[order], np.cumsum(y[order])
        cut = np.flatnonzero(s[1:] > s[:-1])
        cut = cut[(cut + 1 >= MIN_LEAF) & (len(y) - cut - 1 >= MIN_LEAF)]
        if not len(cut):
            continue
        left = cut + 1
        gain = total[cut] ** 2 / left + (total[-1] - total[cut]) ** 2 / (len(y) - left) - base
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (gain[k], j, float((s[cut[k]] + s[cut[k] + 1]) / 2))
    if best[1] is None:
        return
    _, j, at = best
    low = x[rows, j] <= at
    for side, chosen in ((True, rows[low]), (False, rows[~low])):
        new = (*path, (names[j], side, at))
        rules.append(new)
        _grow(x, residual, chosen, names, depth - 1, new, rules, out)


def _holds(rule: Rule, x, names):
    import numpy as np

    held = np.ones(len(x), dtype=bool)
    for name, low, at in rule:
        v = x[:, names.index(name)]
        held &= v <= at if low else v > at
    return held


def fit_rules(x, y, names: list[str]) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules for features ``x`` (numpy, a row a document) and labels ``y``. With one class only the intercept."""
    import numpy as np

    if not len(y):
        return 0.0, []
    rate = np.clip(y.mean(), 1 / (len(y) + 2), 1 - 1 / (len(y) + 2))
    base = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return base, []
    score, rules, draw = np.full(len(y), base), [], np.random.default_rng(7)
    for _ in range(TREES):
        rows = np.sort(draw.permutation(len(y))[: max(2 * MIN_LEAF, len(y) * 7 // 10)])
        out = np.zeros(len(y))
        grown: list[Rule] = []
        _grow(x, y - 1 / (1 + np.exp(-score)), rows, names, DEPTH, (), grown, out)
        rules += grown
        score += 4 * RATE * out
    rules = list(dict.fromkeys(tuple(sorted(r)) for r in rules))
    if not rules:
        return base, []
    held = np.array([_holds(r, x, names) for r in rules], dtype=float).T
    same = {}
    for k in range(held.shape[1]):  # of rules that hold for the same rows the first
        same.setdefault(held[:, k].tobytes(), k)
    rules, held = [rules[k] for k in same.values()], held[:, list(same.values())]
    w, v, b, t = np.zeros(held.shape[1]), np.zeros(held.shape[1]), base, 1.0
    step = 4 / (1e-9 + np.linalg.norm(np.c_[held, np.ones(len(y))], 2) ** 2 / len(y))
    vb, last_b = b, b
    for _ in range(1500):  # proximal gradient with momentum
        g = 1 / (1 + np.exp(-np.clip(held @ v + vb, -35, 35))) - y
        new = v - step * (held.T @ g) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        new_b = vb - step * g.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - last_b)
        w, last_b, t = new, new_b, t2
    return float(last_b), [(r, float(x)) for r, x in zip(rules, w, strict=True) if x]


def compile_score(model: tuple[float, list[tuple[Rule, float]]]) -> Column:
    """The ensemble as a Column over the columns of :func:`features`."""
    base, rules = model
    total = F.lit(base)
    for rule, weight in rules:
        held = F.lit(True)
        for name, low, at in rule:
            held = held & (F.col(name) <= at if low else F.col(name) > at)
        total = total + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def _measured(docs: DataFrame, text_col: str, kept: list[str]) -> DataFrame:
    """``kept`` columns, as a struct that no statistic's name can clash with, and the features."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own"), *[c.alias(n) for n, c in statistics(text).items()])
    return own.select("own", *[c.cast("double").alias(n) for n, c in features().items()])


def quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5, out: int = 0, bound: int = TRAIN_DOCS, text_col: str = "text") -> DataFrame:
    """``docs`` with score in [0, 1] (higher: label 1 likelier) and predicted (1 if score >= 0.3) in place of columns of these names.

    Rows whose crc32(doc_id as text) leaves ``out`` when divided by ``folds`` are held out: their labels are never read. Scores see the
    text alone. Null texts count as empty, whose statistics are zero. Of several label rows of a document the largest
    counts; rows with a null label or id are left out. Without labels all scores are 0.5. Repeated rows are scored each.
    """
    import numpy as np

    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(~crc_fold(F.col("doc_id"), folds, out)).where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    sample = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen), "doc_id")
    names = list(features())
    rows = _measured(sample, "text", ["doc_id", "label"]).select("own.doc_id", "own.label", *names).toPandas()
    rows = rows.sort_values(["doc_id", *names], kind="stable")
    model = fit_rules(rows[names].to_numpy(dtype=float), rows["label"].to_numpy(dtype=float) if len(rows) else np.zeros(0), names)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = _measured(docs, text_col, kept).select("own", compile_score(model).alias("score"))
    return scored.select(*[F.col("own").getField(c).alias(c) for c in kept], "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
