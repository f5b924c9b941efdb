"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits, lower-cased. A document is contaminated by a benchmark item
if, somewhere, ``EQUAL`` of ``WINDOW`` words in a row agree with the words at the same distances
in the item (substitutions are tolerated, at most ``WINDOW - EQUAL`` per window). An item with
fewer words than a window must occur whole and unchanged; one with fewer than ``LEAST`` words is
no evidence and is not searched.

Each mask picks some places of a window and ignores the others. The words it picks are hashed at
every place of the items and of the documents; equal hashes are joined, and on the diagonal of
each hit all windows are compared word by word. The masks are chosen so that however the tolerated
substitutions fall in a window, one mask misses them all at some place: no overlap is lost.

Items are joined in blocks of bounded size: a block is broadcast, and documents stream past it
where they lie, so neither a common passage nor a long document is shuffled. With several blocks,
the documents are written between them.

Defined cases: null and empty texts have no hits; items with a null id or text are left out;
repeated items count once; null and repeated doc ids are kept, row by row; an empty benchmark
contaminates nothing; other columns are kept, except one named ``hits``, which is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm.common import mix, prepare, stored, word_table

WINDOW = 13
EQUAL = 10
LEAST = 5
# Places of a window that a mask looks at. Any three substitutions in 13 words leave one of these
# untouched somewhere (tests try them all).
MASKS = ((0, 1, 5, 7, 8), (0, 1, 3, 5, 6), (0, 1, 4, 8, 9))
# Empty places behind a text, so that no mask reaches from one into the next.
GAP = WINDOW
# Benchmark text broadcast at once.
BLOCK_BYTES = 16 << 20
# Hits compared at a time.
CHUNK = 1 << 18

HITS_DDL = "array<struct<item_id: bigint, start: bigint, end: bigint, equal: bigint>>"


def seeds(words: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places where all words that the mask picks are known (not 0), and their hashes."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    known = words > 0
    fits = known[mask[0] : mask[0] + n].copy()
    for at in mask[1:]:
        fits &= known[at : at + n]
    places = np.flatnonzero(fits)
    hashes = np.full(len(places), len(mask), np.uint64)
    for at in mask:
        hashes = mix(hashes * np.uint64(31) + words[places + at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(at))
    return places, hashes


@dataclass
class Block:
    """Part of a benchmark: its words, and for every mask the sorted hashes with their places."""

    number: dict[str, int]
    words: np.ndarray
    items: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    tables: list[tuple[tuple[int, ...], np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Block:
        table = word_table([text for _, text in items])
        starts, places = table.places(table.counts, GAP)
        words = np.zeros(int((table.counts + GAP).sum()), np.int64)
        words[places] = table.codes + 1
        owner = np.repeat(np.arange(len(items)), table.counts + GAP)
        number = {w: i + 1 for i, w in enumerate(table.distinct)}
        masks = [(mask, WINDOW, None) for mask in MASKS]
        masks += [(tuple(range(n)), n, n) for n in sorted({int(c) for c in table.counts if LEAST <= c < WINDOW})]
        tables = []
        for mask, least, exact in masks:
            at, hashes = seeds(words, mask)
            size = table.counts[owner[at]]
            keep = (size == exact) if exact else (size >= least)
            at, hashes = at[keep], hashes[keep]
            order = np.argsort(hashes, kind="stable")
            tables.append((mask, hashes[order], at[order]))
        return cls(number, words, np.array([i for i, _ in items], np.int64), starts, table.counts, tables)

    def hits(self, texts: list[str | None]) -> list[list[dict[str, int]]]:
        """For every text the overlaps (item_id, start, end in words of the text, equal words)."""
        out: list[list[dict[str, int]]] = [[] for _ in texts]
        table = word_table(texts)
        starts, places = table.places(table.counts, GAP)
        known = np.fromiter((self.number.get(w, 0) for w in table.distinct), np.int64, len(table.distinct))
        words = np.zeros(int((table.counts + GAP).sum()), np.int64)
        words[places] = known[table.codes]
        # A diagonal: a place of the documents less a place of the items.
        pairs = []
        for mask, hashes, item_places in self.tables:
            at, found = seeds(words, mask)
            first, last = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            hit = np.flatnonzero(last > first)
            for a in range(0, len(hit), CHUNK):
                some = hit[a : a + CHUNK]
                size = last[some] - first[some]
                ends = np.cumsum(size)
                item_at = item_places[np.arange(ends[-1]) + np.repeat(first[some] - (ends - size), size)]
                doc_at = np.repeat(at[some], size)
                doc = np.searchsorted(starts, doc_at, "right") - 1
                item = np.searchsorted(self.starts, item_at, "right") - 1
                pairs.append(np.unique(np.stack([doc, item, doc_at - item_at], 1), axis=0))
        if not pairs:
            return out
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, diagonal in np.unique(np.concatenate(pairs), axis=0).tolist():
            overlap = self._verify(words, starts[doc], table.counts[doc], item, diagonal)
            if overlap and overlap > best.get((doc, item), (0, 0, 0)):
                best[doc, item] = overlap
        for (doc, item), (equal, begin, size) in sorted(best.items()):
            out[doc].append({"item_id": int(self.items[item]), "start": -begin, "end": size - begin, "equal": equal})
        return out

    def _verify(self, words: np.ndarray, start: int, count: int, item: int, diagonal: int) -> tuple[int, int, int] | None:
        """(equal words, -first word, words) of what the windows on a diagonal cover."""
        item_start, item_count = int(self.starts[item]), int(self.counts[item])
        begin = max(item_start + diagonal, start)
        end = min(item_start + item_count + diagonal, start + count)
        window = min(WINDOW, item_count)
        if end - begin < window:
            return None
        same = words[begin:end] == self.words[begin - diagonal : end - diagonal]
        sums = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(sums[window:] - sums[:-window] >= (EQUAL if window == WINDOW else window))
        if not len(good):
            return None
        first, last = int(good[0]), int(good[-1]) + window
        return int(sums[last] - sums[first]), -int(begin - start + first), last - first


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The items in blocks of about ``BLOCK_BYTES``, one at a time."""
    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).dropna().distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0]
    if not total:
        return
    count = math.ceil(total / BLOCK_BYTES)
    for number in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        rows = sorted((r["item_id"], r["text"]) for r in part.collect())
        if rows:
            yield Block.of(rows)


def finder(shared: Broadcast):
    @F.pandas_udf(HITS_DDL)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.hits(texts.tolist()))

    return find


def with_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All rows and columns, and ``hits``: the largest overlap with every item that contaminates."""
    spark = prepare(docs.sparkSession)
    out = docs.withColumn("hits", F.array().cast(HITS_DDL))
    previous = None
    for block in blocks(benchmark):
        if previous is not None:
            out = stored(out, "decontaminated")
            previous.destroy()
        previous = spark.sparkContext.broadcast(block)
        out = out.withColumn("hits", F.concat("hits", finder(previous)(F.col("text").cast("string"))))
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that contaminates it."""
    found = with_hits(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows without any overlap, with their columns."""
    return with_hits(docs, benchmark).filter(F.size("hits") == 0).select(*docs.columns)
