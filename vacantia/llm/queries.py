"""Queries with fixed contracts over the standard tables, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table_path
from .fingerprints import edited_fingerprints
from .line_templates import dedup_lines
from .media import draw_waves, media_copies, mosaics
from .mixing import MIX_SQL, mix
from .packing import pack_documents
from .quality import quality
from .simhash import simhash_components
from .token_counts import count_tokens
from .token_ids import read_token_store, write_token_store
from .toxicity import crc_fold, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents over three-word shingles, and their components at two bits."""
    return simhash_components(_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among the images of all embeddings, each drawn as a texture, as the tables have no images of their own; of 20 ids four have an edited copy too."""
    images = mosaics(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", edits=20, draw=draw_waves)
    return media_copies(images).withColumnRenamed("media_id", "vec_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by piece_bpe_32k.model."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, "piece_bpe_32k.model").select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed so that every source has the same weight, in their shuffled order."""
    return mix(_table(spark, sf_dir, "documents").select("doc_id", "source"), seed=7).select("doc_id", "source", "copy", "shuffle_key")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; the fold with remainder 2 of 4 is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, _table(spark, sf_dir, "labels"), "toxic", folds=4, out=2)
    return scored.select("doc_id", crc_fold(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; the fold with remainder 0 of 5 is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality(docs, _table(spark, sf_dir, "labels"), "quality", folds=5, out=0)
    return scored.select("doc_id", crc_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token store of all documents to the shared folder and read it back."""
    folder = table_path(spark, "token-store")
    write_token_store(_table(spark, sf_dir, "documents"), folder, "byte_bpe_50k.json", end_id=0)
    return read_token_store(spark, folder)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template occurs in an earlier document."""
    kept = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_recurring", "n_dropped", F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", size=1024, end_id=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op4_mixing": MIX_SQL}
