"""Operator 3, token counts: whole-token shortcut before merging.

Vocabulary strings proven to encode alone as one token are counted directly; only other words are merged
(see :class:`vacantia.llm.tokenizing.PieceCounter`). A narrow map over the rows: no shuffle, nothing collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of
from .tokenizing import piece_counter, tokenizer_path


def count_tokens(docs: DataFrame, model: str, text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``docs`` with n_bytes, n_tokens (bigint) and over_limit (n_tokens > ``limit``) in place of any columns of these names.

    Counts are those of the model on the whole text, without begin, end or added special tokens. A null text counts as
    the empty text (0 bytes, 0 tokens); repeated rows and rows with null keys are counted each; an empty table gives
    an empty table with the same columns.
    """
    import pyarrow as pa
    from pyspark.sql.types import BooleanType, LongType, StructField, StructType

    path = tokenizer_path(model)
    new = ("n_bytes", "n_tokens", "over_limit")
    kept = docs.drop(*[c for c in new if c != text_col])
    keys = [c for c in kept.columns if c != text_col]
    schema = StructType([*(kept.schema[c] for c in keys), StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])

    def run(batches):
        for batch in slices(batches):
            texts = texts_of(batch.column(batch.schema.get_field_index(text_col)))
            n = piece_counter(path).count(texts)
            rest = [batch.column(batch.schema.get_field_index(c)) for c in keys]
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(sizes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=[*keys, *new])

    return kept.select(*[F.col(f"`{c}`") for c in (*keys, text_col)]).mapInArrow(run, schema)
