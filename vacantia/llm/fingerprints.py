"""Operator 9, document fingerprints: a threshold-scaled sketch, in DataFrame functions only.

A sketch holds every distinct hash of a word shingle that is below a fixed fraction of the hash range, so that it
grows with the document: the share of one document's hashes that another's sketch holds estimates
containment however unequal their lengths, and the sketch of a union is the union of the sketches. A text none of
whose hashes is below keeps its smallest, so that only a text without words has an empty sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words in a shingle; hashes are kept below 2**-FRACTION_BITS of the range, and as so many bits.
WORDS, FRACTION_BITS, HASH_BITS = 5, 2, 40


def word_hashes(text: Column) -> Column:
    """Hash of each lower-cased word of ``text``, in order."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"\s+"), ""), lambda w: F.xxhash64(w))


def sketch(hashes: str, words: int = WORDS) -> Column:
    """Sketch (sorted array<bigint>) over the column named ``hashes`` of :func:`word_hashes`; fewer words than a shingle are one shingle.

    The word hashes must be a column of their own, as each shingle looks its words up in it.
    """
    own = F.col(hashes)
    every = F.transform(own, lambda _, i: F.shiftrightunsigned(F.xxhash64(*[F.get(own, i + k) for k in range(words)]), 64 - HASH_BITS))
    every = F.slice(every, F.lit(1), F.greatest(F.size(own) - (words - 1), F.lit(1)))
    return every


def keep_below(every: str) -> Column:
    """Of the shingle hashes in the column named ``every``, those below the threshold, or else the smallest."""
    low = F.filter(F.col(every), lambda h: h < (1 << (HASH_BITS - FRACTION_BITS)))
    return F.when(F.size(low) > 0, F.sort_array(F.array_distinct(low))).when(F.size(every) > 0, F.array(F.array_min(every))).otherwise(F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the sketch of its column ``text`` as ``name``; each step is a projection of its own so that no hash is taken twice."""
    hashed = df.withColumn("__words", word_hashes(F.col(text)))
    return hashed.withColumn("__all", sketch("__words")).drop("__words").withColumn(name, keep_below("__all")).drop("__all")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a``'s document that ``b``'s has; of two empty sketches 1, of an empty and another 0."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise((F.size(b) == 0).cast("double"))


def merge(a: Column, b: Column) -> Column:
    """Sketch of the union of two documents' shingles; a smallest hash that stood in for none goes where the other has any below."""
    both = F.sort_array(F.array_union(a, b))
    low = F.filter(both, lambda h: h < (1 << (HASH_BITS - FRACTION_BITS)))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def to_text(hashes: Column) -> Column:
    """A sketch as text, ten lowercase hex digits a hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), HASH_BITS // 4, "0")), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, sketch) of every row. Null texts count as empty; repeated rows are returned each; other columns are ignored."""
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_sketch(own, "text", "sketch").select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "sketch")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id bigint, text) and of each text whose second half is replaced by the beginning of the next document.

    Next is by descending doc_id, null ids last, repeated ids in the order of a hash of the text; after the last comes the first. Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts count as
    empty. An empty table gives an empty result; where all ids are null, the last document is followed by an empty text.

    Documents are dealt by id range to many small windows in one shuffle. The ranges end at ids of the table, whose
    documents also go, as neighbours without a result of their own, to the range whose last document they follow.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = own.select("doc_id").where("doc_id is not null")
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = ids.agg(F.max("doc_id")).first()[0]
    found = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 4 * parts)).first()[0] if top is not None else None
    ends = sorted({*(found or ()), *([top] if top is not None else [])})
    bounds = F.array(*map(F.lit, ends)).cast("array<bigint>")
    # the range of an id: how many ranges end below it
    home = F.coalesce(F.size(F.filter(bounds, lambda e: e < F.col("doc_id"))), F.lit(0))
    guests = F.when(F.col("doc_id").isin(ends), F.array((F.col("range") + 1) % len(ends))) if ends else F.lit(None).cast("array<int>")
    stay = F.struct(F.col("range").alias("at"), F.lit(False).alias("guest"))
    visit = F.transform(F.coalesce(guests, F.array().cast("array<int>")), lambda k: F.struct(k.alias("at"), F.lit(True).alias("guest")))
    measured = with_sketch(own, "text", "sketch").withColumn("tie", F.xxhash64("text")).withColumn("range", home)
    # a guest is after a range's last document: it is the largest of the range below, or, after the lowest range, the largest of all
    dealt = measured.select("doc_id", "text", "sketch", "tie", F.explode(F.concat(F.array(stay), visit)).alias("to"))
    dealt = dealt.select("doc_id", "text", "sketch", "tie", F.col("to.at").alias("at"), F.col("to.guest").alias("guest"))
    order = Window.partitionBy("at").orderBy("guest", F.col("doc_id").desc_nulls_last(), "tie")
    paired = dealt.withColumn("next", F.lead(F.struct("text", "sketch")).over(order)).where(~F.col("guest"))
    # only in a table without any id is there no first document to come after the last: its text counts as empty
    paired = paired.withColumn("next", F.coalesce("next", F.struct(F.lit("").alias("text"), F.array().cast("array<bigint>").alias("sketch"))))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("substring(next.text, 1, cast(floor(length(text) / 2) as int))"))
    result = paired.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "sketch", containment(F.col("sketch"), F.col("next.sketch")).alias("near_next"), F.when(half > 0, edited).otherwise(F.col("text")).alias("edited"))
    result = with_sketch(result, "edited", "edited_sketch")
    return result.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        to_text(F.col("sketch")).alias("fingerprint"),
        to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        "near_next",
    )
