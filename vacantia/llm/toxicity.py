"""Operator 5, toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: its lower-cased words, their first three to eight letters (inflected forms of a
word share those), pairs of neighbours, and pairs with one or two words between them, all hashed to 2**BITS places. A feature that
the text has twice or more is another one besides, at the place that its first differs from by TWICE.
The learner has a rate for each coordinate and an L1 penalty that leaves most weights at zero, so that
the model is a short list of (place, weight), at most 2**BITS long, sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import claim, release, slices, texts_of

BITS = 20
#: Documented bound of the labelled sample that is learnt from, by a hash of the ids, and passes over it.
TRAIN_DOCS = 8_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
THRESHOLD = 0.3
STEMS = (3, 4, 5, 6, 7, 8)
TWICE = 0x5BD1E

_WORD_ENTRIES = 300_000
_TRIM = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»¿¡“”„‘’…–—"


class _Words(dict):
    """Row of each raw word in ``rows``: hashes of the word without outer punctuation and of its first letters."""

    def __init__(self):
        import numpy as np

        super().__init__()
        self.rows = np.zeros((1024, 1 + len(STEMS)), dtype="uint64")

    def __missing__(self, raw: str) -> int:
        import numpy as np
        import xxhash

        word = raw.strip(_TRIM) or raw
        k = self[raw] = len(self)
        if k >= len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        self.rows[k] = [xxhash.xxh64_intdigest(x.encode(), n) for n, x in enumerate((word, *(word[:k] for k in STEMS)))]
        return k


_CACHE: list[_Words] = []


def features(text: str):
    """Places of all features of a text, with repeats."""
    import numpy as np

    claim("toxicity", _CACHE.clear)
    if not _CACHE or len(_CACHE[0]) > _WORD_ENTRIES:
        _CACHE[:] = [_Words()]
    table, raw = _CACHE[0], text.lower().split()
    ids = np.fromiter(map(table.__getitem__, raw), dtype="int64", count=len(raw))
    rows = table.rows[ids]
    word = rows[:, 0]
    found = [rows.ravel()]
    for gap in (1, 2, 3):
        if len(word) > gap:
            found.append((word[:-gap] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(gap)) ^ (word[gap:] * np.uint64(0xC2B2AE3D27D4EB4F)))
    return ((np.concatenate(found) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype("int32")


def feature_set(text: str):
    """Distinct places of a text's features, those of repeated ones included."""
    import numpy as np

    at, n = np.unique(features(text), return_counts=True)
    return np.concatenate([at, at[n > 1] ^ np.int32(TWICE)])


class Ftrl:
    """FTRL-proximal for logistic loss over sets of places; place 2**BITS is the intercept, which has no L1 penalty."""

    def __init__(self):
        import numpy as np

        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at):
        import numpy as np

        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 1 << BITS, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at, label: int) -> None:
        import numpy as np

        at = np.append(np.unique(at), 1 << BITS)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def crc_fold(key: Column, folds: int, out: int) -> Column:
    """Whether crc32 of the id's text leaves ``out`` when divided by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == out, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> list[tuple[int, float]]:
    """Weights (place, weight) that are not zero, learnt from at most ``bound`` documents.

    ``labels`` has doc_id and label (0 or 1; null rows are left out; of several rows of a document the largest counts). Texts
    are turned to features in all tasks and learnt from in one, in the order of a hash of the ids. Without labels there are no weights.
    """
    chosen = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in slices(batches):
            sets = [feature_set(t).tobytes() for t in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], names=["doc_id", "label", "at"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        # places stay in the batches' own buffers
        rows = [(label.as_py(), np.frombuffer(at.as_buffer(), "int32")) for b in batches for label, at in zip(b.column(1), b.column(2), strict=True)]
        model = Ftrl()
        for _ in range(EPOCHS):
            for label, at in rows:
                model.learn(at, label)
        w = model.weights(np.arange((1 << BITS) + 1))
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int32()), pa.array(w[kept], pa.float64())], names=["place", "weight"])
        del rows, model, w
        release()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    sets = texts.mapInArrow(hashed, "doc_id bigint, label int, at binary").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "at")
    return [(r[0], r[1]) for r in sets.mapInArrow(fit, "place int, weight double").collect()]


def score(docs: DataFrame, weights: list[tuple[int, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns but earlier ones named score or predicted) with score in [0, 1] and predicted (1 if score >= 0.3).

    Only the text is looked at. Null and empty texts have the score of the intercept alone (0.5 without weights).
    """
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    own = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType([*own.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        dense = np.zeros((1 << BITS) + 1)
        for place, weight in sent.value:
            dense[place] = weight
        known = dense[:-1] != 0
        known |= known[np.arange(1 << BITS) ^ TWICE]
        for batch in slices(batches):
            out = []
            for text in texts_of(batch.column(batch.schema.get_field_index(text_col))):
                at = features(text)
                at, n = np.unique(at[known[at]], return_counts=True)
                at = np.union1d(at, at[n > 1] ^ np.int32(TWICE))
                out.append(1 / (1 + np.exp(-np.clip(dense[at].sum() + dense[-1], -35, 35))))
            s = pa.array(out, pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, s, pa.array([int(x >= THRESHOLD) for x in out], pa.int32())], names=[*kept, "score", "predicted"])

    return own.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4, out: int = 2, bound: int = TRAIN_DOCS) -> DataFrame:
    """Score ``docs`` for toxicity with a model learnt from the ``labels`` outside the held-out fold.

    Rows whose crc32(doc_id as text) leaves ``out`` when divided by ``folds`` are held out: their labels are never read. Repeated rows
    are scored each; an empty table gives an empty result with the same columns.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    return score(docs, train(docs, known.where(~crc_fold(F.col("doc_id"), folds, out)), bound))
