"""Operator 8, line dedup: a log-template tree of fixed depth, built with shuffles instead of one by one.

A line is filed by its number of tokens and its leading tokens, tokens with a digit (0 to 9) being variable. In a leaf, two
lines have the same template if they differ in few tokens, which then are variable too; a template is a component of such links. A
template that several documents have recurs: it stays in the first of them, or in none, and is dropped from the others.

Links are found exactly and without comparing all lines of a leaf. The rest of a line is cut into one more segments than
tokens may differ, so that lines of a template agree on a segment: (leaf, segment) is a key. Lines of a key that has few are
compared. A larger key is refined: what the key leaves open is cut into parts, some of which lines of a template must agree on, and
each choice of those is a key of its own. Where little is left open, each choice of variable tokens is masked instead: lines with equal masks have the
same template, and all are linked to the smallest, so that a frequent template costs a row a line and mask and no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, connected_components, join_frequent, materialize, remove_table, slices, texts_of

#: Lines with fewer tokens and fewer characters are left alone: they recur by chance.
MIN_TOKENS, MIN_CHARS = 3, 40
LEAD = 2
VARIABLE = "<*>"
#: Lines of a key that are compared with each other; positions left open that are masked instead of cut into parts.
COLD, OPEN = 64, 24
#: Lines, or keys of several lines, that are looked up by a broadcast of their names; more are joined by shuffle.
BROADCAST_LINES = 500_000
#: Lines that a task remembers having filed.
SEEN = 100_000


def variable_fields(n: int) -> int:
    """Tokens that may differ, besides those with digits, within a template of ``n`` tokens."""
    return 0 if n < 6 else 1 if n < 12 else 2


def masked(line: str) -> list[str]:
    """Tokens of a line, those with a digit as variable ones; lines that would keep no token, or have too few, keep all."""
    tokens = line.split()
    if len(tokens) < MIN_TOKENS or not any(d in line for d in "0123456789"):
        return tokens
    found = [VARIABLE if any(d in t for d in "0123456789") else t for t in tokens]
    return found if any(t is not VARIABLE for t in found) else tokens


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _name(text: str, n_tokens: int, min_tokens: int) -> int | None:
    import xxhash

    return _signed(xxhash.xxh3_64_intdigest(text)) if n_tokens >= min_tokens or len(text) >= MIN_CHARS else None


def line_id(line: str, min_tokens: int = MIN_TOKENS) -> int | None:
    """Hash of a line with its digit tokens masked; None for lines too short to be filed."""
    tokens = masked(line)
    return _name(" ".join(tokens), len(tokens), min_tokens)


def line_keys(tokens: list[str]) -> list[int]:
    """Tree keys of a masked line whose template may have variable tokens."""
    import xxhash

    n, lead, rest = len(tokens), tokens[:LEAD], tokens[LEAD:]
    cuts = variable_fields(n) + 1
    leaf = f"{n} {' '.join(lead)} "
    return [_signed(xxhash.xxh3_64_intdigest(leaf + f"{k} " + " ".join(rest[len(rest) * k // cuts : len(rest) * (k + 1) // cuts]))) for k in range(cuts)]


def token_hashes(tokens: list[str]) -> bytes:
    """The 64-bit hash of each token."""
    import xxhash

    return b"".join([xxhash.xxh3_64_digest(t) for t in tokens])


def file_line(tokens: list[str]) -> tuple[list[int], bytes]:
    """Keys of a masked line, and the hashes of its tokens."""
    return line_keys(tokens), token_hashes(tokens)


def open_positions(n: int, segment: int):
    """Positions that the key of a segment leaves open in lines of ``n`` tokens."""
    import numpy as np

    cuts, rest = variable_fields(n) + 1, n - LEAD
    at = np.arange(LEAD, n, dtype="int32")
    return np.concatenate([at[: rest * segment // cuts], at[rest * (segment + 1) // cuts :]])


def refine(key: int, tokens, left) -> tuple[bool, list[int], list]:
    """Whether what follows are masks, and the keys below ``key`` of a line: its token hashes, and the positions that the key leaves open.

    Lines that agree on the key's positions and differ in few others share one of these keys; sharing a mask, they have the same template.
    """
    import numpy as np
    import xxhash

    k = variable_fields(len(tokens))
    final = len(left) <= max(OPEN, 2 * k)
    parts = [left[i : i + 1] for i in range(len(left))] if final else np.array_split(left, 2 * k)
    keys, still = [], []
    for skipped in combinations(range(len(parts)), min(k, len(parts))):
        held = [p for i, p in enumerate(parts) if i not in skipped]
        held = np.concatenate(held) if held else left[:0]
        keys.append(_signed(xxhash.xxh3_64_intdigest(b"%d %d %s " % (key, final, bytes(skipped)) + tokens[held].tobytes())))
        still.append(np.concatenate([parts[i] for i in skipped]))
    return final, keys, still


def few_links(lines: list[int], forms: list[bytes]) -> list[tuple[int, int]]:
    """Links that join lines of one key as comparing all pairs does: of each two components one link."""
    import numpy as np

    links = []
    size = np.array([len(x) for x in forms])
    for length in np.unique(size).tolist():
        at = np.nonzero(size == length)[0]
        tokens = np.frombuffer(b"".join(forms[i] for i in at), "u8").reshape(len(at), -1)
        group, most = np.arange(len(at)), variable_fields(length // 8)
        for i in range(len(at)):
            j = i + 1 + np.nonzero(group[i + 1 :] != group[i])[0]
            j = j[(tokens[j] != tokens[i]).sum(axis=1) <= most]
            for other, k in zip(*np.unique(group[j], return_index=True), strict=True):
                links.append((lines[at[i]], lines[at[j[k]]]))
                group[group == other] = group[i]
    return links


def _pairs(batch_links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in batch_links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 20):
        yield _pairs([x for members in batch.column(0).to_pylist() for x in few_links([m["line"] for m in members], [m["form"] for m in members])])


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    schema = [("key", pa.int64()), ("line", pa.int64()), ("left", pa.binary()), ("mask", pa.bool_())]
    for batch in slices(batches, 50):
        out = [[] for _ in schema]
        for key, line, segment, left, form in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            tokens = np.frombuffer(form, "u8")
            still_open = open_positions(len(tokens), segment) if left is None else np.frombuffer(left, "i4")
            final, keys, still = refine(key, tokens, still_open)
            out[0] += keys
            out[1] += [line] * len(keys)
            out[2] += [None if final else x.astype("i4").tobytes() for x in still]
            out[3] += [final] * len(keys)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, schema, strict=True)], names=[n for n, _ in schema])


def _hash_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([token_hashes(x.split(" ")) for x in batch.column(1).to_pylist()], pa.binary())], names=["line", "form"])


def template_links(forms: DataFrame, cold: int = COLD) -> DataFrame:
    """Links (a, b) that join all lines of a template. ``forms`` is a stored table (line, keys, form), repeats allowed, of lines by :func:`file_line`.

    A form may also be the masked line itself, a string: only lines that share a key then have their tokens hashed.
    """
    spark = forms.sparkSession
    links, stored = spark.createDataFrame([], "a bigint, b bigint"), []

    def keep(table: DataFrame, label: str) -> DataFrame:
        table, path = materialize(table, label)
        stored.append(path)
        return table

    def of_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
        """Rows of ``table`` with one of ``keys`` (key, n), how many rows have it."""
        return table.join(F.broadcast(keys), "key") if keys.count() <= BROADCAST_LINES else join_frequent(table, keys, "key")

    def several(table: DataFrame) -> DataFrame:
        """Rows of keys with two lines or more, and n, how many the key has."""
        # lines are counted once only these keys' are left: a sketch for every key is most of what this shuffles
        sizes = table.groupBy("key").agg(F.min("line").alias("lo"), F.max("line").alias("hi"), F.count("*").alias("n"))
        sizes = keep(sizes.where("lo <> hi").select("key", "n"), "line-keys")
        found = keep(of_keys(table, sizes).drop("n").distinct(), "line-level")
        return keep(of_keys(found, keep(found.groupBy("key").agg(F.count("*").alias("n")), "line-keys")), "line-level")

    nothing = F.lit(None).cast("binary")
    level = several(forms.select("line", F.posexplode("keys").alias("segment", "key")).select("key", "line", "segment", nothing.alias("left")))
    wanted = F.broadcast(level.select("line")) if level.count() <= BROADCAST_LINES else level.select("line")
    known = forms.join(wanted, "line", "left_semi").select("line", "form").dropDuplicates(["line"])  # a line has the same form everywhere
    if dict(forms.dtypes)["form"] == "string":
        known = known.mapInArrow(_hash_tokens, "line bigint, form binary")
    known = keep(known, "line-forms")
    while True:
        few = level.where(F.col("n") <= cold).select("key", "line").join(known, "line")
        members = few.groupBy("key").agg(F.collect_list(F.struct("line", "form")).alias("members")).select("members")
        links = links.union(keep(members.mapInArrow(_compare, "a bigint, b bigint"), "line-links"))
        many = level.where(F.col("n") > cold)
        if many.limit(1).count() == 0:
            break
        below = many.select("key", "line", "segment", "left").join(known, "line").select("key", "line", "segment", "left", "form")
        below = keep(below.mapInArrow(_refine, "key bigint, line bigint, left binary, mask boolean"), "line-refined")
        masks = below.where("mask").select("key", "line")
        hubs = keep(masks.groupBy("key").agg(F.min("line").alias("b"), F.count("*").alias("n")).where("n > 1"), "line-masks")
        links = links.union(keep(join_frequent(masks, hubs, "key").where("line <> b").select(F.col("line").alias("a"), "b").distinct(), "line-links"))
        level = several(below.where("not mask").select("key", "line", F.lit(0).alias("segment"), "left"))
    result, _ = materialize(links.distinct(), "template-links")
    for path in stored:
        remove_table(spark, path)
    return result


def recurring_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, line, first): the lines (by hash) of each document whose template other documents have too; first where it stays.

    Rows with a null doc_id are left out; rows with the same doc_id are one document.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, line bigint, keys array<bigint>, form string"
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filed: set[int] = set()
        claim("lines", filed.clear)
        for batch in slices(batches, 500):
            out = [[] for _ in types]
            for doc, whole in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                seen = set()
                for line in whole.split("\n"):
                    tokens = masked(line)
                    text = " ".join(tokens)
                    name = _name(text, len(tokens), min_tokens)
                    if name is None or name in seen:
                        continue
                    seen.add(name)
                    keys, form = None, None
                    if name not in filed and variable_fields(len(tokens)):
                        if len(filed) >= SEEN:
                            filed.clear()
                        filed.add(name)
                        keys, form = line_keys(tokens), text
                    for column, x in zip(out, (doc, name, keys, form), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "line", "keys", "form"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    lines, lines_path = materialize(own.mapInArrow(file, schema), "lines")
    links = template_links(lines.where("keys is not null").select("line", "keys", "form"))
    labels, labels_path = materialize(connected_components(links, "templates"), "templates")

    each, each_path = materialize(lines.groupBy("line").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")), "line-documents")
    each = each.join(labels, each["line"] == labels["node"], "left").select("line", "n", "lo", "hi", F.coalesce("component", "line").alias("template"))
    ends = each.groupBy("template").agg(F.min("lo").alias("first_doc"), F.max("hi").alias("last_doc"), F.count("*").alias("lines")).where("first_doc < last_doc")
    ends, ends_path = materialize(ends.select("template", "first_doc", F.col("lines").alias("n")), "recurring-templates")
    recurring = join_frequent(each.withColumnRenamed("n", "rows"), ends, "template").select("line", "first_doc", F.col("rows").alias("n"))
    recurring, recurring_path = materialize(recurring, "recurring-names")
    found = join_frequent(lines.select("doc_id", "line"), recurring, "line").select("doc_id", "line", (F.col("doc_id") == F.col("first_doc")).alias("first"))
    found, _ = materialize(found.distinct(), "recurring-lines")
    for path in (lines_path, labels_path, each_path, ends_path, recurring_path):
        remove_table(spark, path)
    return found


def dedup_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, keep_first: bool = True) -> DataFrame:
    """``docs`` (doc_id bigint, text and others) with recurring lines dropped from text, and n_lines, n_recurring, n_dropped.

    A line that several documents have, or lines of one template, stays in the first of them (smallest doc_id), or, without ``keep_first``, in none. Lines
    of fewer than ``min_tokens`` tokens and MIN_CHARS characters are left alone.
    n_lines counts the lines of the whole text, n_recurring the distinct lines whose template other documents have,
    n_dropped the lines taken out. A document's own repeats are no recurrence. Null texts stay null and have no lines, an
    empty text has one; rows with a null doc_id stay as they are. A text that loses all its lines is empty. Repeated rows of a
    doc_id are one document and are each returned. Columns of these three names are replaced; others stay.
    """
    from pyspark.sql.types import IntegerType, StructField, StructType

    new = ("n_lines", "n_recurring", "n_dropped")
    found = recurring_lines(docs, min_tokens)
    gone = F.when(~F.col("first"), F.col("line")) if keep_first else F.col("line")
    drops = found.groupBy("doc_id").agg(F.count("*").alias("__recurring"), F.collect_list(gone).alias("__drop"))
    kept = [c for c in docs.columns if c not in new]
    own = docs.select(*[F.col(f"`{c}`") for c in kept])
    joined = own.withColumn("__id", F.col("doc_id").cast("bigint")).join(drops.withColumnRenamed("doc_id", "__id"), "__id", "left").drop("__id")
    schema = StructType([*own.schema.fields, *(StructField(c, IntegerType()) for c in new)])
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in slices(batches, 500):
            whole = batch.column(at).cast(pa.string())
            n_lines = pc.fill_null(pc.add(pc.count_substring(whole, "\n"), 1), 0).to_numpy()
            losing = pc.and_(pc.is_valid(whole), pc.greater(pc.fill_null(pc.list_value_length(batch.column(len(kept) + 1)), 0), 0))
            n_dropped, texts = n_lines * 0, []
            # only texts that may lose a line become Python strings
            for i, text, drop in zip(pc.indices_nonzero(losing).to_pylist(), whole.filter(losing).to_pylist(), batch.column(len(kept) + 1).filter(losing).to_pylist(), strict=True):
                lines, gone = text.split("\n"), set(drop)
                left = [x for x in lines if line_id(x, min_tokens) not in gone]
                n_dropped[i] = len(lines) - len(left)
                texts.append("\n".join(left))
            columns = list(batch.columns[: len(kept)])
            columns[at] = pc.replace_with_mask(whole, losing, pa.array(texts, pa.string()))
            counts = (n_lines, pc.fill_null(batch.column(len(kept)), 0), n_dropped)
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c).cast(pa.int32()) for c in counts)], names=[*kept, *new])

    return joined.mapInArrow(run, schema)
