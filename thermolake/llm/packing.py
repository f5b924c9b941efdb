"""Best-fit packing by large-item matching.

Pieces longer than a third of the capacity pair at most twice per bin: from the longest down, each
takes the longest partner that still fits. Shorter pieces, again from the longest down, go where
the least room is left (best fit), and open new bins when none has room.

Pieces of one length are alike, so the plan is made on the number of pieces per length, a table
of at most ``capacity`` rows whatever the corpus. It is a list of *runs*: pieces number ``first``
to ``first + count`` of a length go to bins ``bin``, ``bin + 1``, ... at one offset. Numbering the
pieces of a length takes a count per (length, partition) and a running sum; no length, however
common, is gathered in a task, and no partition is packed apart from the others.

Defined cases: a null text is an empty one and has only its end id; null and repeated ids are kept,
each row is packed; equal lengths are interchangeable; an empty table gives an empty result; other
columns of the input are ignored by ``pieces`` and carried along by ``pack``.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermolake.llm.common import prepare, stored
from thermolake.llm.tokens import encoder

CAPACITY = 1024
PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 2) -> DataFrame:
    """Token ids of every document and its end id; only longer ones are cut.

    A cut document has pieces of ``capacity`` ids, save that its first piece takes the remainder.
    ``ids`` are little-endian unsigned 32-bit integers.
    """
    prepare(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(batch["text"])):
                ids = np.concatenate([ids, end])
                head = len(ids) % capacity or capacity
                cuts = [0, *range(head, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for name, value in zip(rows, (doc_id, piece, a, b - a, ids[a:b].tobytes())):
                        rows[name].append(value)
            yield pa.RecordBatch.from_pydict(
                rows,
                pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]),
            )

    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return source.mapInArrow(cut, PIECES_DDL)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first, count, bin, offset) that place all pieces of a histogram."""
    left = {size: n for size, n in histogram.items() if n}
    if any(size < 1 or size > capacity for size in left):
        raise ValueError(f"pieces must have 1 to {capacity} ids")
    placed = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left: (first bin, bins)
    rooms: list[int] = []  # the same, ascending
    bins = 0

    def put(size: int, count: int, first_bin: int, offset: int) -> None:
        runs.append((size, placed[size], count, first_bin, offset))
        placed[size] += count
        left[size] -= count

    def keep(free: int, first_bin: int, count: int) -> None:
        if free and count:
            if free not in room:
                room[free] = []
                bisect.insort(rooms, free)
            room[free].append((first_bin, count))

    large = sorted((size for size in left if 3 * size > capacity), reverse=True)
    for size in large:
        while left[size]:
            partner = next((p for p in large if p <= min(size, capacity - size) and left[p]), None)
            if partner == size:
                count = left[size] // 2
                partner = partner if count else next((p for p in large if p < size and left[p] and p + size <= capacity), None)
            if partner is None:
                count = left[size]
                put(size, count, bins, 0)
                keep(capacity - size, bins, count)
            else:
                count = count if partner == size else min(left[size], left[partner])
                put(size, count, bins, 0)
                put(partner, count, bins, size)
                keep(capacity - size - partner, bins, count)
            bins += count
    for size in sorted((size for size in left if 3 * size <= capacity), reverse=True):
        while left[size]:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):  # open as many bins as these pieces fill
                count = -(-left[size] // (capacity // size))
                keep(capacity, bins, count)
                bins += count
                continue
            free = rooms[at]
            first_bin, count = room[free].pop()
            if not room[free]:
                del room[free]
                rooms.pop(at)
            each = min(free // size, left[size])
            full = min(count, left[size] // each)
            for i in range(each):
                put(size, full, first_bin, capacity - free + i * size)
            keep(free - each * size, first_bin, full)
            keep(free, first_bin + full, count - full)
    return np.array(runs, np.int64).reshape(-1, 5)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``.

    Names starting with ``_pack_`` are taken by the operator.
    """
    spark = items.sparkSession
    rows = stored(items.withColumn("_pack_row", F.monotonically_increasing_id()), "pieces")
    part = F.shiftright("_pack_row", 33)
    counts = rows.groupBy("length", part.alias("_pack_part")).agg(F.count("*").alias("_pack_n"))
    counts = stored(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_pack_n").alias("n")).collect()}
    runs = plan(histogram, capacity)

    before = Window.partitionBy("length").orderBy("_pack_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_pack_part", F.coalesce(F.sum("_pack_n").over(before), F.lit(0)).alias("_pack_first"))
    within = Window.partitionBy("length", "_pack_part").orderBy("_pack_row")
    narrow = rows.select("length", part.alias("_pack_part"), "_pack_row")
    numbered = (
        narrow.withColumn("_pack_nth", F.row_number().over(within) - 1)
        .join(firsts, ["length", "_pack_part"])
        .select("_pack_row", "length", (F.col("_pack_first") + F.col("_pack_nth")).alias("_pack_rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((runs[:, 1], runs[:, 0]))
        size, first, _, first_bin, offset = runs[order].T
        key = size * (1 << 48) + first
        for batch in batches:
            length, rank = (batch[c].to_numpy() for c in ("length", "_pack_rank"))
            run = np.searchsorted(key, length * (1 << 48) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch["_pack_row"], pa.array(first_bin[run] + rank - first[run]), pa.array(offset[run])],
                ["_pack_row", "sequence_id", "offset"],
            )

    placed = numbered.mapInArrow(place, "_pack_row bigint, sequence_id bigint, offset bigint")
    return rows.drop("sequence_id", "offset").join(placed, "_pack_row").drop("_pack_row")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and the ids of its pieces in order.

    A sequence has at most ``capacity`` pieces, so its group is bounded.
    """
    by_offset = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(by_offset.alias("parts")).select("sequence_id", joined.alias("ids"))
