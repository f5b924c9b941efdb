"""Vector codes: parts of integer vectors, each named by its nearest entry of a codebook, found by GNAT.

A component x becomes floor(4096 x); a vector is cut into equal consecutive parts, and each part
position has a codebook of its own. Rounds of assignment and integer means move the entries; everything
is whole numbers, so a result does not depend on partitions or on the order of additions.

Nearest entries come from a GNAT (geometric near-neighbour access tree) over the entries. A node
has a few split points; every other entry of it belongs to the nearest split point's child. For each
(split point, child) pair the node keeps the least and the greatest distance from the split point to the
entries of the child, its own split point included. A query measures its distance to the split
points; a child whose stored range from some split point does not meet [distance - r, distance + r],
r the best distance so far, cannot hold anything as near and is left out with all below it. Only
a strict gap counts, so equally near entries stay in; distances are rounded outwards, so a rounded
root never discards; and what is compared in the end are integer squares, equal ones to the lower index.

In Spark: rounds stream the table through Arrow batches; a task sends one row of sums and a count per
used entry, at most parts x entries, whatever it has read. The driver holds the codebooks alone.

Odd rows: vectors that are null or hold null or non-finite components take no part, nor do those
whose length differs from that of the kept vector with the smallest id, or is no positive multiple of the
number of parts; a null id comes last among the ids; repeated rows and ids count each on their own, equal ids
in the order of their vectors; with fewer vectors than entries a codebook is shorter; entries that
are equal leave all to the first; an empty table gives an empty result. Null labels are one label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm.common import stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Split points of a node; a node of at most so many entries is a leaf.
SPLITS = 4
# Components up to this keep all squares and sums of a part in 64 bits; beyond, Python's integers.
SAFE = 1 << 27


def scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(4096 x) as integers, of any size."""
    floored = np.floor(vectors.astype(np.float64) * SCALE)
    if floored.size and np.abs(floored).max() > SAFE:
        return np.array([int(x) for x in floored.ravel()], object).reshape(floored.shape)
    return floored.astype(np.int64)


def squares(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one point, exactly."""
    return ((rows - point) ** 2).sum(axis=1)


def _root_down(square: np.ndarray) -> np.ndarray:
    """Not above the root of an integer."""
    return np.nextafter(np.nextafter(np.sqrt(np.nextafter(square.astype(np.float64), 0)), 0), 0)


def _root_up(square: np.ndarray) -> np.ndarray:
    """Not below the root of an integer."""
    return np.nextafter(np.nextafter(np.sqrt(np.nextafter(square.astype(np.float64), np.inf)), np.inf), np.inf)


@dataclass
class Node:
    """Split points (indices of entries), their children, and ranges[i, j]: the distances from split
    point i to split point j and everything below it."""

    splits: list[int]
    children: list[Node | None] = field(default_factory=list)
    least: np.ndarray | None = None
    greatest: np.ndarray | None = None

    @classmethod
    def build(cls, entries: np.ndarray, members: list[int]) -> Node | None:
        """A node over some entries; split points are chosen far from each other, first ones first."""
        if not members:
            return None
        splits = [members[0]]
        nearest = squares(entries[members], entries[members[0]])
        while len(splits) < min(SPLITS, len(members)):
            far = [(-int(nearest[i]), m) for i, m in enumerate(members) if m not in splits]
            splits.append(min(far)[1])
            nearest = np.minimum(nearest, squares(entries[members], entries[splits[-1]]))
        below: list[list[int]] = [[] for _ in splits]
        for m in members:
            if m not in splits:
                gaps = [int(d) for d in squares(entries[splits], entries[m])]
                below[gaps.index(min(gaps))].append(m)
        node = cls(splits, [cls.build(entries, b) for b in below])
        held = [[s, *b] for s, b in zip(splits, below)]
        node.least = np.array([[_root_down(squares(entries[h], entries[s])).min() for h in held] for s in splits])
        node.greatest = np.array([[_root_up(squares(entries[h], entries[s])).max() for h in held] for s in splits])
        return node


@dataclass
class Gnat:
    """The tree over the entries of one codebook, and how many distances its searches measured."""

    entries: np.ndarray
    root: Node | None = None
    measured: int = 0

    def __post_init__(self) -> None:
        self.root = Node.build(self.entries, list(range(len(self.entries))))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every row; the lower index of equal ones."""
        n = len(rows)
        kind = object if object in (rows.dtype, self.entries.dtype) else np.int64
        index, best = np.full(n, len(self.entries), np.int64), np.zeros(n, kind)
        if n and self.root:
            self._visit(self.root, rows, np.arange(n), index, best)
        return index, best

    def _measure(self, rows: np.ndarray, who: np.ndarray, entry: int, index: np.ndarray, best: np.ndarray) -> np.ndarray:
        square = squares(rows[who], self.entries[entry])
        self.measured += len(who)
        held, least = index[who], best[who]
        better = (held == len(self.entries)) | (square < least) | ((square == least) & (entry < held))
        better = better.astype(bool)
        index[who[better]], best[who[better]] = entry, square[better]
        return square

    def _visit(self, node: Node, rows: np.ndarray, who: np.ndarray, index: np.ndarray, best: np.ndarray) -> None:
        measured = [self._measure(rows, who, s, index, best) for s in node.splits]
        low, high = [_root_down(d) for d in measured], [_root_up(d) for d in measured]
        for j, child in enumerate(node.children):
            if child is None:
                continue
            radius = _root_up(best[who])  # later children meet what earlier ones have found
            alive = np.ones(len(who), bool)
            for i in range(len(node.splits)):
                gap = (np.nextafter(low[i] - radius, -np.inf) > node.greatest[i, j]) | (np.nextafter(high[i] + radius, np.inf) < node.least[i, j])
                alive &= ~gap
            if alive.any():
                self._visit(child, rows, who[alive], index, best)


def kept(rows: DataFrame, parts: int = PARTS) -> tuple[DataFrame, int]:
    """Rows (id, vector, label) that take part, and the length of their vectors (0 if there are none)."""
    whole = F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = rows.select("id", "vector", "label").filter(whole)
    usable = usable.filter((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    first = usable.orderBy(F.asc_nulls_last("id"), "vector").select(F.size("vector")).first()
    length = first[0] if first else 0
    return usable.filter(F.size("vector") == length), length


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return scaled(pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), length))


@dataclass
class Codebooks:
    """Entries by part, each an integer matrix; the same number of entries in every part."""

    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components as decimal text, by part, entry and position, comma-joined."""
        text = ",".join(str(int(x)) for book in self.books for x in book.ravel())
        return hashlib.sha256(text.encode()).hexdigest()

    def assign(self, vectors: np.ndarray, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
        """Indices (rows x parts) and squared distances of whole vectors."""
        found = [tree.nearest(part) for tree, part in zip(trees, np.split(vectors, len(self.books), axis=1))]
        return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def fit(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of all ``kept`` rows: the smallest ids' parts, moved by ``rounds`` integer means."""
    start = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()
    first = scaled(np.array([r["vector"] for r in start], np.float64).reshape(len(start), length))
    books = Codebooks([np.ascontiguousarray(b) for b in np.split(first, parts, axis=1)])
    for _ in range(rounds if len(start) else 0):
        books = Codebooks(_moved(rows, books, length))
    return books


def _moved(rows: DataFrame, books: Codebooks, length: int) -> list[np.ndarray]:
    """One round: every part to its nearest entry, entries to the floors of their means."""
    parts, width = len(books.books), length // len(books.books)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books.books]
        sums = [np.zeros((len(book), width + 1), object) for book in books.books]
        for batch in batches:
            vectors = _matrix(batch.column("vector"), length)
            index, _ = books.assign(vectors, trees)
            for part, mine in enumerate(np.split(vectors, parts, axis=1)):
                added = np.zeros((len(sums[part]), width + 1), mine.dtype)
                np.add.at(added[:, :width], index[:, part], mine)
                added[:, width] += np.bincount(index[:, part], minlength=len(added))
                sums[part] += added
        found = [(p, e, i, int(x)) for p, s in enumerate(sums) for e in range(len(s)) if s[e, width] for i, x in enumerate(s[e])]
        if found:
            *keys, value = zip(*found)
            columns = [pa.array(k, pa.int32()) for k in keys] + [pa.array([f"{v}" for v in value], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "value"])

    sent = rows.select("vector").mapInArrow(total, "part int, entry int, place int, value string")
    whole = sent.groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    got = {(r["part"], r["entry"], r["place"]): int(r["value"]) for r in whole.collect()}  # parts x entries x (width + 1)
    moved = []
    for part, book in enumerate(books.books):
        new = [[got[part, e, i] // got[part, e, width] for i in range(width)] if (part, e, width) in got else list(book[e]) for e in range(len(book))]
        wide = max((abs(int(x)) for row in new for x in row), default=0) > SAFE
        moved.append(np.array(new, object if wide else np.int64).reshape(len(book), width))
    return moved


def encode(rows: DataFrame, books: Codebooks, length: int) -> DataFrame:
    """(id, label, code, error): the entries' indices in two hex digits each, and the squared distances summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in books.books]
        for batch in batches:
            index, square = books.assign(_matrix(batch.column("vector"), length), trees)
            text = [row.tobytes().hex() for row in index.astype(np.uint8)]
            error = pa.array([int(e) for e in square.sum(axis=1)], pa.int64())
            columns = [batch.column("id"), batch.column("label"), pa.array(text, pa.string()), error]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "vector", "label").mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) for all rows (id, vector, label) that take part."""
    usable, length = kept(rows, parts)
    usable = stored(usable, "vectors")
    books = fit(usable, length, parts, entries, rounds)
    coded = stored(encode(usable, books, length), "codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    whole = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
    return whole.withColumn("codebooks_sha256", F.lit(books.digest()))
