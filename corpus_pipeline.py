"""Corpus pipeline: documents are filtered, cleaned, deduplicated, mixed and packed.

Each stage works on all that the one before it kept; between stages the documents are written as Parquet to the
shared folder and read again. All stages but the last return the columns of documents; the last returns the sequences to train on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm.common import materialize, small_batches
from vacantia.llm.line_templates import dedup_lines
from vacantia.llm.mixing import mix
from vacantia.llm.near_duplicates import drop_near_duplicates
from vacantia.llm.packing import pack_sequences
from vacantia.llm.toxicity import toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity(docs.select(*COLUMNS), labels, "toxic", folds=4, out=2).where("predicted = 0").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines go whose template an earlier document has; n_chars is counted anew where a line went."""
    small_batches(spark)
    kept = dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (SimHash fingerprints of operator 1 within two bits, or five words, similarity 0.8) the document with the smallest id stays."""
    small_batches(spark)
    return drop_near_duplicates(docs.select(*COLUMNS), words=5, threshold=0.8, distance=2)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, or not, so that every source has the same weight, and shuffled."""
    return mix(docs.select(*COLUMNS), seed=7).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: the ids of each, and the pieces of documents that they are."""
    small_batches(spark)
    return pack_sequences(docs, "byte_bpe_50k.json", size=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]
#: SQL can't express the trained filter, the template tree and the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs, _ = materialize(docs, name.replace(" ", "-"))
    return docs
