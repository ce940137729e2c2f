"""Operator 10, best-fit packing: best fit, longest first, of documents into sequences of fixed length.

Documents longer than a sequence are cut into whole sequences, the first piece being the shorter one. Pieces of one length are alike: how many
there are of each length, at most as many numbers as a sequence is long, decides what best fit by falling length makes of them. The driver
plans on these counts (:func:`plan_sequences`): kinds of sequences, how many of each, and which lengths they hold. The pieces are then numbered by length, across
tasks, and a piece's number says its sequence and its place there, so that the pieces are shuffled once.

Sequences of over PLANNED tokens are filled by bulk-synchronous sweeps instead (:func:`sweep_pieces`). There whole sequences need no fitting. The other
pieces are dealt in supersteps, class by class from the longest lengths. A superstep sorts its pieces and the
gaps of all open sequences together by range of size, larger ones first, a gap before a piece of its size, and sweeps down: a gap is put
on a stack, a piece takes the top, which is the smallest gap that holds it. Pieces that want the same gap thus get it and its successors in the
order of their ranks. Each task sweeps its own range; what a range leaves over, pieces without a gap and then gaps without a piece, is
matched across ranges by depth: the stack's height at the range's begin follows from what the ranges before left over, and a piece
takes the last gap that raised the stack to the height it lowers. Then gaps are updated, and the class is swept again until no gap holds any
of its pieces; as many sequences as these need at least are opened with the longest of them, and so on.

A gap that holds several of the longest of a class offers that many slots. All state is in tables of the shared folder, a few numbers a piece;
only counts come to the driver.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, remove_table, slices, texts_of
from .tokenizing import byte_encoder, tokenizer_path

#: Longest sequence that is planned from the counts of its lengths; a plan has at most three kinds of sequences a length.
PLANNED = 8192
#: Pieces and gaps that a range of a sweep has at least, about; it has the root of their number where that is more, and there are no more ranges.
RANGE_ROWS = 20_000
#: A class is swept again if at least one in so many of its pieces found a gap; else it opens sequences first.
AGAIN = 3
#: Fractions of a sequence at which classes of lengths begin.
CLASSES = (2, 4)


def short_ids(data: bytes) -> bytes:
    """Ids, little-endian uint32, in two bytes each if all are below 2^16, else as they are."""
    import numpy as np

    ids = np.frombuffer(data, "<u4")
    return ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else data


def _join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences (sequence_id, lengths, ids, and what else there is) with the ids of their spans, of :func:`short_ids`, as one array."""
    import numpy as np

    for batch in slices(batches):
        lengths, spans = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_pylist()
        data = b"".join(spans)
        if len(data) == 2 * lengths.sum():
            ids = np.frombuffer(data, "<u2").astype("int32")
        else:
            ids = np.concatenate([np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4").astype("int32") for x, n in zip(spans, lengths.tolist(), strict=True)])
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(batch.column(1).value_lengths().to_numpy()))]
        whole = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
        yield pa.RecordBatch.from_arrays([batch.column(0), whole, *batch.columns[3:]], names=["sequence_id", "ids", *batch.schema.names[3:]])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, with_ids: bool = False) -> DataFrame:
    """Pieces of tokenized documents: key (a number of its own for each), doc_id, piece, start, length, ids_crc32, and ids (:func:`short_ids`) if asked for.

    The key counts rows within partitions: it is to be stored before it is read twice.
    """
    path = tokenizer_path(tokenizer)
    schema = "key bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        end, key = end_id.to_bytes(4, "little"), TaskContext.get().partitionId() << 36
        for batch in slices(batches):
            out = [[] for _ in types]
            for doc, ids in zip(batch.column(0).to_pylist(), byte_encoder(path).encode(texts_of(batch.column(1))), strict=True):
                ids += end
                n, at, piece = len(ids) // 4, 0, 0
                while at < n:
                    length = (n % size or size) if at == 0 else size
                    data = ids[4 * at : 4 * (at + length)]
                    for column, x in zip(out, (key, doc, piece, at, length, zlib.crc32(data), *[short_ids(data)] * with_ids), strict=True):
                        column.append(x)
                    at, piece, key = at + length, piece + 1, key + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def sweep_range(piece, size):
    """Best fit within one range, sorted by falling size, gaps before pieces: the event of the gap that each event's piece takes, -1 for none.

    The stack's height before and after each event is a running sum; a piece takes the gap that last raised the stack to the height that
    the piece lowers, which, with events sorted by that height, stands right before it.
    """
    import numpy as np

    height = np.cumsum(np.where(piece, -1, 1)) + piece
    order = np.argsort(height, kind="stable")
    a, b = order[:-1], order[1:]
    ok = (height[a] == height[b]) & ~piece[a] & piece[b]
    taken = np.full(len(piece), -1)
    taken[b[ok]] = a[ok]
    return taken


def _sweep_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's events (size, piece, id, slot, times) to its pieces with the gap they take, and what is left over, with its rank.

    The slots that a gap offers are counted only here; those that none takes, its first ones, are a row again, with the rank of the last.
    """
    import numpy as np
    from pyspark import TaskContext

    batches = list(batches)
    size, piece, own, slot, times = (np.concatenate([np.zeros(0, t), *(b.column(k).to_numpy(zero_copy_only=False) for b in batches)]) for k, t in enumerate(("int64", bool, "int64", "int32", "int32")))
    event = np.repeat(np.arange(len(piece)), times)
    slot = slot[event] + (np.arange(len(event)) - (np.cumsum(times) - times)[event])
    size, piece, own = size[event], piece[event], own[event]
    taken = sweep_range(piece, size)
    used = np.zeros(len(piece), dtype=bool)
    used[taken[taken >= 0]] = True
    keep = np.flatnonzero(~used)
    at, found = taken[keep], taken[keep] >= 0
    over = piece[keep] & ~found, ~piece[keep]
    rank = np.where(over[0], np.cumsum(over[0]), np.where(over[1], np.cumsum(over[1]), 0))
    left = np.bincount(event[keep[over[1]]], minlength=len(times))[event[keep]]
    row = np.append(event[keep[1:]] != event[keep[:-1]], True) if len(keep) else found
    keep, at, found, rank, left = keep[row], at[row], found[row], rank[row], np.where(piece[keep], 1, left)[row]
    slot[keep] -= np.where(piece[keep], 0, left - 1)
    seq = pa.array(own[at], pa.int64(), mask=~found)
    arrays = [pa.array(np.full(len(keep), TaskContext.get().partitionId()), pa.int32()), pa.array(piece[keep]), pa.array(own[keep]), pa.array(np.where(found, slot[at], slot[keep]), pa.int32()), pa.array(size[keep]), seq, pa.array(rank, pa.int64()), pa.array(left, pa.int32())]
    yield pa.RecordBatch.from_arrays(arrays, names=["part", "piece", "id", "slot", "size", "seq", "rank", "times"])


def sweep(left: DataFrame, gaps: DataFrame, longest: int, least: int, n_left: int, n_gaps: int) -> tuple[DataFrame, str]:
    """Best fit of the pieces ``left`` (key, length) to ``gaps`` (seq, gap): a stored table of them (key, length, seq, slot), seq null without a gap, and its path.

    A gap is taken by one piece, or offers a slot of size ``longest`` to each of up to twice as many as there are pieces for it; ``least`` is the
    shortest piece. The counts size the ranges.
    """
    slots = F.least(F.greatest(F.floor(F.col("gap") / longest), F.lit(1)), F.lit(max(1, -(-2 * n_left // max(1, n_gaps)))))
    offered = gaps.where(F.col("gap") >= least).withColumn("more", slots.cast("int") - 1)
    run = lambda size, slot, times: F.struct(size.cast("bigint").alias("size"), slot.alias("slot"), times.alias("times"))
    largest, others = run(F.col("gap") - longest * F.col("more"), F.col("more"), F.lit(1)), run(F.lit(longest), F.lit(0), F.col("more"))
    runs = offered.select("seq", F.explode(F.when(F.col("more") > 0, F.array(largest, others)).otherwise(F.array(largest))).alias("r"))
    events = runs.select("r.size", F.lit(False).alias("piece"), F.col("seq").alias("id"), "r.slot", "r.times")
    events = events.unionByName(left.select(F.col("length").alias("size"), F.lit(True).alias("piece"), F.col("key").alias("id"), F.lit(0).alias("slot"), F.lit(1).alias("times")))
    order = [F.desc("size"), F.asc("piece"), F.asc("id"), F.asc("slot")]
    rows = 3 * n_left + n_gaps
    ranges = max(1, -(-rows // max(RANGE_ROWS, math.isqrt(rows))))
    ranged = events.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    swept, swept_path = materialize(ranged.mapInArrow(_sweep_ranges, "part int, piece boolean, id bigint, slot int, size bigint, seq bigint, rank bigint, times int"), "swept")

    if ranges == 1:
        return swept.where("piece").select(F.col("id").alias("key"), F.col("size").alias("length"), "seq", "slot"), swept_path
    fitted = lambda table: table.select(F.col("id").alias("key"), F.col("size").alias("length"), "seq", F.coalesce("slot", F.lit(0)).alias("slot"))
    over = swept.where("rank > 0")
    parts = [tuple(r) for r in over.groupBy("part").agg(F.count_if("piece"), F.coalesce(F.sum(F.when(~F.col("piece"), F.col("times"))), F.lit(0))).collect()]  # a row a range
    if len(parts) < 2 or not all(sum(p[k] for p in parts) for k in (1, 2)):
        return fitted(swept.where("piece")), swept_path
    begin, height = [], 0
    for part, n_pieces, n_open in sorted(parts):
        begin.append((part, n_pieces, height))
        height += n_open - n_pieces
    # the levels of a range's gaps that later pieces come down to; those below are of no use
    low, ranges = height, []
    for part, n_pieces, height in reversed(begin):
        ranges.append((part, n_pieces, height, max(low, height - n_pieces)))
        low = min(low, height - n_pieces)
    begin = F.broadcast(left.sparkSession.createDataFrame(ranges, "part int, pieces bigint, height bigint, low bigint"))
    last = F.col("height") - F.col("pieces") + F.col("rank")
    first = F.greatest(last - F.col("times") + 1, F.col("low") + 1)
    levels = F.when(F.col("piece"), F.array(F.col("height") - F.col("rank") + 1)).when(last >= first, F.sequence(first, last))
    # at one height a range has at most a piece and then a gap
    before = F.lag(F.struct("piece", "id", "slot")).over(Window.partitionBy("level").orderBy("part", F.desc("piece")))
    late = over.join(begin, "part").withColumn("level", F.explode(levels))
    late = late.withColumn("slot", F.when(F.col("piece"), F.col("slot")).otherwise(F.col("slot") + (F.col("level") - last + F.col("times") - 1).cast("int")))
    late = late.withColumn("before", before).where("piece")
    taken = F.col("before.id").isNotNull() & ~F.col("before.piece")
    late = late.withColumn("seq", F.when(taken, F.col("before.id"))).withColumn("slot", F.when(taken, F.col("before.slot")))
    result = materialize(fitted(swept.where("rank = 0")).unionByName(fitted(late)), "fitted")
    remove_table(left.sparkSession, swept_path)
    return result


def plan_sequences(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit by falling length of ``counts`` pieces of each length: (how many sequences, their (length, times), longest first) for each kind.

    A piece takes the smallest gap that holds it, and its equals fill what is left of that gap, which is then the smallest. So all sequences of
    a kind are filled alike, but for one at most that a length does not fill: a length adds two kinds, and one more if it opens sequences.
    """
    open_gaps: list[int] = []
    kinds: dict[int, list[tuple[int, tuple | None]]] = {}  # by gap: how many sequences, and their (length, times, those before)

    def add(gap: int, n: int, held: tuple | None) -> None:
        if n:
            if gap not in kinds:
                insort(open_gaps, gap)
            kinds.setdefault(gap, []).append((n, held))

    def fill(gap: int, n: int, held: tuple | None, length: int, count: int) -> int:
        """``n`` sequences with a gap take ``count`` pieces, or as many as they hold; how many are left."""
        each = gap // length
        full = min(n, count // each)
        some = count - full * each if full < n else 0
        add(gap - each * length, full, (length, each, held))
        add(gap - some * length, int(some > 0), (length, some, held))
        add(gap, n - full - (some > 0), held)
        return count - full * each - some

    for length, count in sorted(counts.items(), reverse=True):
        at = bisect_left(open_gaps, length)
        while count and at < len(open_gaps):
            gap = open_gaps.pop(at)
            for n, held in kinds.pop(gap):
                count = fill(gap, n, held, length, count)
            at = bisect_left(open_gaps, length)
        if count:
            fill(size, -(-count // (size // length)), None, length, count)
    plan = []
    for gap in sorted(kinds):
        for n, held in kinds[gap]:
            lengths = []
            while held:
                lengths.append(held[:2])
                held = held[2]
            plan.append((n, lengths[::-1]))
    return plan


def _number_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their range and their number among those of their length there; ``length`` is the last column."""
    import numpy as np
    from pyspark import TaskContext

    seen: dict[int, int] = {}
    for batch in batches:
        length = batch.column(batch.num_columns - 1).to_numpy()
        number, order = np.empty(len(length), "int64"), np.argsort(length, kind="stable")
        found, begin, n = np.unique(length[order], return_index=True, return_counts=True)
        number[order] = np.arange(len(length)) - np.repeat(begin, n) + np.repeat([seen.get(x, 0) for x in found.tolist()], n).astype("int64")
        for x, k in zip(found.tolist(), n.tolist(), strict=True):
            seen[x] = seen.get(x, 0) + k
        part = pa.array(np.full(len(length), TaskContext.get().partitionId()), pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns, part, pa.array(number)], names=[*batch.schema.names, "part", "number"])


def place_pieces(pieces: DataFrame, size: int) -> DataFrame:
    """``pieces`` (a stored table with key and length) without key, with sequence_id and offset."""
    import numpy as np

    if size > PLANNED:
        return sweep_pieces(pieces, size)
    spark = pieces.sparkSession
    columns = [c for c in pieces.columns if c not in ("key", "length")]
    rows = pieces.count()
    ranged = pieces.repartitionByRange(max(1, -(-rows // max(RANGE_ROWS, math.isqrt(rows)))), "length", "key").select(*columns, "length")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    numbered, path = materialize(ranged.mapInArrow(_number_range, f"{kinds}, part int, number bigint"), "numbered")
    # lengths are in order of the ranges: a row for each length and each range, about
    counts = sorted(map(tuple, numbered.groupBy("length", "part").count().collect()))
    of_length: dict[int, int] = {}
    for length, _, n in counts:
        of_length[length] = of_length.get(length, 0) + n
    # places of all pieces in a row, by length and then by sequence: where a range's pieces of a length begin, and where those of a kind do
    own = np.array([part * (size + 1) + length for length, part, _ in counts], dtype="int64")
    first = np.cumsum([0, *(n for *_, n in counts)])[:-1]
    order = np.argsort(own)
    own, first = own[order], first[order]
    held, sequence = [], 0
    for n, lengths in plan_sequences(of_length, size):
        offset = 0
        for length, times in lengths:
            held.append((length, sequence, offset, times, n * times))
            offset += length * times
        sequence += n
    _, kind, place, each, n = np.array(sorted(held), dtype="int64").reshape(-1, 5).T
    begin = np.cumsum(n) - n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, part, number = (batch.column(c).to_numpy() for c in ("length", "part", "number"))
            at = first[np.searchsorted(own, part.astype("int64") * (size + 1) + length)] + number
            k = np.searchsorted(begin, at, side="right") - 1
            at = at - begin[k]
            arrays = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(kind[k] + at // each[k]), pa.array(place[k] + at % each[k] * length)], names=[*names, "sequence_id", "offset"])

    names = [c for c in pieces.columns if c != "key"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*names).schema)
    result, _ = materialize(numbered.mapInArrow(run, f"{kinds}, sequence_id bigint, offset bigint"), "packed")
    remove_table(spark, path)
    return result


def sweep_pieces(pieces: DataFrame, size: int) -> DataFrame:
    """As :func:`place_pieces`, in sweeps."""
    spark = pieces.sparkSession
    steps: list[DataFrame] = []
    stored: list[str] = []

    def assign(table: DataFrame) -> None:
        """Pieces (key, length, seq, slot) that have their sequence, in the order of the calls."""
        steps.append(table.select("key", "length", "seq", F.lit(len(steps)).alias("step"), F.col("slot").cast("int").alias("slot")))

    def keep(table: DataFrame, label: str, rows: int) -> DataFrame:
        table, path = materialize(table, label, rows)
        stored.append(path)
        return table

    own = pieces.select("key", "length")
    found = lambda table: table.select("key", "length", F.col("key").alias("seq"), F.lit(0).alias("slot"))
    # two pieces of more than half a sequence never share one
    alone = own.where((F.col("length") * 2 > size) & (F.col("length") < size))
    assign(found(alone))
    gaps = alone.select(F.col("key").alias("seq"), (size - F.col("length")).alias("gap"))
    cuts = [*dict.fromkeys(size // k for k in CLASSES), 0]
    for longest, above in zip(cuts, cuts[1:], strict=False):
        left = own.where((F.col("length") <= longest) & (F.col("length") > above))
        swept = 0  # pieces that the last sweep had, 0 if it is to be swept in any case
        while True:
            sizes = gaps.select("gap").where(F.col("gap") > above).unionByName(left.select((-F.col("length")).alias("gap")))
            counts = {r["gap"]: r["count"] for r in sizes.groupBy("gap").count().collect()}  # a row for each length and each gap up to a sequence's
            lengths = {-x: k for x, k in counts.items() if x < 0}
            if not lengths:
                break
            n, least = sum(lengths.values()), min(lengths)
            n_gaps = sum(k for x, k in counts.items() if x >= least) if not swept or (swept - n) * AGAIN >= swept else 0
            if n_gaps:
                fitted, path = sweep(left, gaps, longest, least, n, n_gaps)
                stored.append(path)
                swept, taken = n, fitted.where("seq is not null")
                assign(taken)
                moved = gaps.unionByName(taken.select("seq", (-F.col("length")).alias("gap"))).groupBy("seq").agg(F.sum("gap").alias("gap")).where("gap > 0")
                gaps = keep(moved, "gaps", sum(counts.values()))
                left = fitted.where("seq is null").select("key", "length")
                continue
            # the fewest sequences that can hold them are opened with the longest
            total = sum(x * k for x, k in lengths.items())
            first = longest_pieces(left, lengths, max(-(-total // size), -(-n // max(1, size // (above + 1)))))
            opened, left = left.where(first), left.where(~first)
            assign(found(opened))
            gaps = gaps.unionByName(opened.select(F.col("key").alias("seq"), (size - F.col("length")).alias("gap")).where("gap > 0"))
            swept = 0
    assigned = steps[0]
    for step in steps[1:]:
        assigned = assigned.unionByName(step)
    in_order = Window.partitionBy("seq").orderBy("step", "slot", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = assigned.select("key", F.col("seq").alias("sequence_id"), F.coalesce(F.sum("length").over(in_order), F.lit(0)).alias("offset"))
    columns = [c for c in pieces.columns if c != "key"]
    whole = pieces.where(F.col("length") == size).select(*columns, F.col("key").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    result, _ = materialize(whole.unionByName(pieces.where(F.col("length") < size).join(placed, "key").select(*columns, "sequence_id", "offset")), "packed")
    for path in stored:
        remove_table(spark, path)
    return result


def longest_pieces(left: DataFrame, counts: dict[int, int], n: int) -> Column:
    """Condition that holds for the ``n`` longest pieces of ``left`` (key, length); among equals for those whose keys have the least hashes.

    The shortest length comes from ``counts``, how many pieces each length has, the largest hash digit by digit from counts by digit.
    """
    for length in sorted(counts, reverse=True):
        if n < counts[length]:
            break
        n -= counts[length]
    else:
        return F.lit(True)
    bits, digit, prefix, least = 60, 12, 0, 0
    own = F.shiftrightunsigned(F.xxhash64("key"), 64 - bits)
    for shift in range(bits - digit, -1, -digit):
        if n:
            within = left.where((F.col("length") == length) & (F.shiftright(own, shift + digit) == prefix))
            for prefix, count in sorted(map(tuple, within.groupBy(F.shiftright(own, shift)).count().collect())):  # at most 2**12 rows
                least = prefix << shift
                if n < count:
                    break
                n, least = n - count, (prefix + 1) << shift
    least += n > 0  # equal hashes to the last bit are taken together
    return (F.col("length") > length) | ((F.col("length") == length) & (own < F.lit(least)))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """Best-fit packing of ``docs`` (doc_id bigint, text) into sequences of at most ``size`` tokens.

    Returns for each piece doc_id, piece, start, length, ids_crc32, sequence_id, offset. Tokens are the tokenizer's, no
    special ones added, then ``end_id``. A null text is the empty text (one token). Repeated rows and repeated or null
    doc_ids are packed each as a document of its own. An empty table gives no pieces. Other columns are ignored.
    """
    pieces, path = materialize(token_pieces(docs, tokenizer, end_id, size), "pieces")
    result = place_pieces(pieces, size)
    remove_table(docs.sparkSession, path)
    return result


def pack_sequences(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """The packed sequences of ``docs`` (doc_id bigint, text): sequence_id, ids array<int>, and pieces, in their order, as :func:`pack_documents` gives them.

    ``pieces`` is array<struct<doc_id, piece, start, length, ids_crc32, offset>>. Nulls, repeats and empty tables are as there. Texts are
    tokenized once; ids are shuffled by piece and then by sequence, in two bytes each where they allow it.
    """
    pieces, path = materialize(token_pieces(docs, tokenizer, end_id, size, with_ids=True), "pieces")
    placed = place_pieces(pieces.select("key", F.col("key").alias("own"), "length"), size).select("own", "sequence_id", "offset")
    spans = pieces.join(placed.hint("merge"), F.col("key") == F.col("own")).select("sequence_id", "offset", "doc_id", "piece", "start", "length", "ids_crc32", "ids")
    # dealt by sequence before they are gathered, or each task would gather its own pieces first, few of which share one
    whole = spans.repartition("sequence_id").groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in spans.columns if c != "sequence_id"]))).alias("spans"))
    piece = lambda x: F.struct(*[x[c].alias(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "offset")])
    whole = whole.select("sequence_id", "spans.length", "spans.ids", F.transform("spans", piece).alias("pieces"))
    result, _ = materialize(whole.mapInArrow(_join_spans, f"sequence_id bigint, ids array<int>, pieces {whole.schema['pieces'].dataType.simpleString()}"), "sequences")
    remove_table(docs.sparkSession, path)
    return result


def build_sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """The sequences themselves, (sequence_id, ids array<int>), of ``docs`` packed by :func:`pack_documents` with the same arguments.

    A sequence never has more than ``size`` ids. Pieces are found again by id, number, length and checksum, so that copies of a document, and documents that
    share an id, each have their ids in each of their places.
    """
    same = ["doc_id", "piece", "length", "ids_crc32"]
    known = token_pieces(docs, tokenizer, end_id, size, with_ids=True).select(*same, "ids").dropDuplicates(same).alias("k")
    spans = packed.alias("p").join(known, [F.col(f"p.{c}").eqNullSafe(F.col(f"k.{c}")) for c in same]).select("p.sequence_id", "p.offset", "p.length", "k.ids")
    whole = spans.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("spans"))
    return whole.select("sequence_id", "spans.length", "spans.ids").mapInArrow(_join_spans, "sequence_id bigint, ids array<int>")
