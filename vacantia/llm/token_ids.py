"""Operator 7, token-id output: documents compressed one by one under a shared zstandard dictionary.

A store is a folder with two Parquet tables. ``dictionary`` has one row (dict_hash, dictionary). ``blocks`` has
one row for about a MiB of documents in ascending doc_id order: part and block (order), first_doc and last_doc,
n_docs, n_tokens, in_part (ids of the part's blocks before), dict_hash, ``index`` (for each document its id, whether that is null, number of ids and
frame length) and ``payload`` (one zstandard frame a document). A document is thus read by
its block alone: Parquet statistics find the row, the index the frame.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, texts_of
from .tokenizing import byte_encoder, tokenizer_path

#: Documents that the dictionary is trained on, and its size: the documented bound of that sample.
DICTIONARY_DOCS = 1000
DICTIONARY_BYTES = 64 * 1024
BLOCK_BYTES = 1 << 20
_ENTRY = "<q?II"


def pack_ids(ids: bytes) -> bytes:
    """Little-endian uint32 ids as uint16 where all fit, with a leading byte that says which."""
    import numpy as np

    a = np.frombuffer(ids, "<u4")
    return b"\x02" + a.astype("<u2").tobytes() if not a.size or a.max() < 1 << 16 else b"\x04" + ids


def unpack_ids(data: bytes) -> bytes:
    import numpy as np

    return np.frombuffer(data, "<u2", offset=1).astype("<u4").tobytes() if data[:1] == b"\x02" else data[1:]


def _train(docs: DataFrame, path: str, end_id: int) -> tuple[str, bytes]:
    """The dictionary, trained in one task on at most DICTIONARY_DOCS documents chosen by a hash of their ids (rows without an id are not chosen, of rows with the same id
    the least text is); empty where they are too few."""
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        end = end_id.to_bytes(4, "little")
        samples = [pack_ids(x + end) for f in frames for x in byte_encoder(path).encode([t or "" for t in f["text"]])]
        try:
            found = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 16)), samples).as_bytes()
        except (zstandard.ZstdError, ValueError):
            found = b""
        yield pd.DataFrame({"dictionary": [found]})

    # ids below a hash bound first, so that whatever the table's size a few thousand ids meet, and of the texts only those chosen
    share = min(1.0, 4 * DICTIONARY_DOCS / max(1, docs.count()))
    hashed = docs.select("doc_id", F.xxhash64("doc_id").alias("h")).where(F.col("doc_id").isNotNull() & (F.shiftrightunsigned("h", 11) <= int(share * (1 << 53))))
    ids = hashed.distinct().orderBy("h", "doc_id").limit(DICTIONARY_DOCS).select("doc_id")
    sample = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id")
    rows = sample.select("text").coalesce(1).mapInPandas(run, "dictionary binary").collect()
    found = bytes(rows[0][0]) if rows else b""
    return hashlib.sha256(found).hexdigest()[:16], found


def write_token_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> None:
    """Write ``docs`` (doc_id bigint, text) to a new store at ``folder``.

    Each document is the tokenizer's ids, no special tokens added, and ``end_id``. A null text is the empty
    text (only the end id). Documents are in ascending doc_id order, null ids first, repeated ids in the order of a
    hash of the text. An empty table gives a store without blocks. Other columns are ignored.
    """
    spark = docs.sparkSession
    path = tokenizer_path(tokenizer)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    dict_hash, dictionary = _train(docs, path, end_id)
    spark.createDataFrame([(dict_hash, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    schema = "part int, block int, first_doc bigint, last_doc bigint, n_docs bigint, n_tokens bigint, in_part bigint, dict_hash string, index binary, payload binary"
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True)
        end, part, block = end_id.to_bytes(4, "little"), TaskContext.get().partitionId(), 0
        index, frames, known, size, tokens, before = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = [part, block, known[0] if known else None, known[-1] if known else None, len(index), tokens, before, dict_hash, b"".join(index), b"".join(frames)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=names)

        for batch in slices(batches):
            for doc, ids in zip(batch.column(0).to_pylist(), byte_encoder(path).encode(texts_of(batch.column(1))), strict=True):
                ids += end
                frame = pack.compress(pack_ids(ids))
                index.append(struct.pack(_ENTRY, doc or 0, doc is None, len(ids) // 4, len(frame)))
                frames.append(frame)
                if doc is not None:
                    known.append(doc)
                size, tokens = size + len(frame), tokens + len(ids) // 4
                if size >= BLOCK_BYTES:
                    yield close()
                    block, size, tokens, before = block + 1, 0, 0, before + tokens
                    index, frames, known = [], [], []
        if index:
            yield close()

    ordered = docs.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def _frames(index: bytes, payload: bytes, dictionary: bytes):
    import zstandard

    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    at = 0
    for doc, null, n, size in struct.iter_unpack(_ENTRY, index):
        yield None if null else doc, n, lambda at=at, size=size: unpack_ids(unpack.decompress(payload[at : at + size]))
        at += size


def _dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    name, data = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(bytes(data)).hexdigest()[:16] != name:
        raise ValueError(f"{folder}: the dictionary is not the one of its hash")
    return name, bytes(data)


def read_token_store(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of a store: doc_id, start (ids of all documents before), n_tokens, ids_crc32, and ids if asked for.

    Starts come from one sum a part, as many rows as the writer had tasks, and each block's place in its part. A block whose
    dictionary hash is not that of the store fails the read.
    """
    name, dictionary = _dictionary(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != name:
                    raise ValueError(f"block {row['part']}/{row['block']} was written under another dictionary")
                start, out = row["start"], ([], [], [], [], [])
                for doc, n, ids in _frames(row["index"], row["payload"], dictionary):
                    data = ids()
                    if len(data) != 4 * n:
                        raise ValueError(f"document {doc}: {len(data) // 4} ids instead of {n}")
                    values = (doc, start, n, zlib.crc32(data), np.frombuffer(data, "<u4").astype("int32") if with_ids else None)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    start += n
                arrays = [pa.array(c, pa.int64()) for c in out[:4]]
                yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(out[4], pa.list_(pa.int32()))] if with_ids else [])], names=["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])])

    placed = blocks.select("part", "block", "in_part", "dict_hash", "index", "payload").join(F.broadcast(parts), "part")
    return placed.withColumn("start", F.col("in_part") + F.col("part_start")).drop("in_part", "part_start").mapInArrow(run, schema)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[int] | None:
    """Ids of the first document of this id, from its block alone; None where there is none."""
    import numpy as np

    _, dictionary = _dictionary(spark, folder)
    rows = spark.read.parquet(f"{folder}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).orderBy("part", "block").select("index", "payload").limit(1).collect()
    for index, payload in rows:
        for doc, _, ids in _frames(bytes(index), bytes(payload), dictionary):
            if doc == doc_id:
                return np.frombuffer(ids(), "<u4").tolist()
    return None
