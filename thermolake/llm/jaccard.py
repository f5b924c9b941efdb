"""N-gram Jaccard join by a count-vector R-tree.

A document is the set of its distinct ``WIDTH``-word shingles; two link at a Jaccard similarity of
80 % or more. Copies of a set are one node. Three steps lose no link:

1. **Cells.** A linked pair of sizes a <= b differs in at most (a + b) / 9 shingles. Sets are cut
   into more blocks (by hash) than that, so some block is the same in both; equal blocks meet in a cell.
   Block counts depend on a size class; a set that can link into the next class is cut for that
   one, too. Should only empty blocks be left to agree, both sets know it and meet in a cell of
   their class for that case.
2. **Tiles.** Cells with the same smallest document, their hub, make a group of candidates; groups
   are packed into tiles of bounded size; a larger group is cut into chunks, and every pair of
   chunks is a tile. Sharing a passage makes no chain of groups.
3. **R-tree.** In a tile, shingles are hashed into ``GROUPS`` groups, and a set is the point of its
   group counts. The overlap of two sets is at most the sum of the coordinate minima, that of
   two nodes at most the sum over the minima of their upper corners. Pairs whose bound is
   too low are dropped with their nodes; the others are verified on the sets, unless a verified
   chain joins them already.

Defined cases: null and empty texts have no shingles and link with nothing; a row with a null id
has a null component and links with nothing; rows that share an id are one document (a repeated
row changes nothing); an empty table gives an empty result; other columns are ignored by
``classes`` and kept by ``one_of_each``; sets of any size are whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermolake.llm.common import mix, prepare, shingle_hashes, stored, word_hashes, words
from thermolake.llm.components import components

WIDTH = 5
# Link: 100 * overlap >= PERCENT * union, that is 9 * overlap >= 4 * (a + b) for 80.
PERCENT = 80
# Sizes up to which two sets of 80 % must be equal.
EQUAL_BELOW = 4
# Group counts per set, points per node of the tree, and children per node.
GROUPS = 128
LEAF = 16
# Sets and shingles in a tile.
TILE_SETS = 512
TILE_SHINGLES = 2_000_000
# Pairs compared at a time.
CHUNK = 16_384
# Cells held by a task before they go on.
HELD_CELLS = 500_000
# Sets that a task remembers, so that it sends copies once.
REMEMBERED = 500_000


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    return np.unique(shingle_hashes(word_hashes(words(text)), width))


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that are equal for equal sets."""
    with np.errstate(over="ignore"):
        first = mix(hashes + np.uint64(len(hashes))).sum(dtype=np.uint64)
        second = mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return int(first.astype(np.int64)), int(second.astype(np.int64))


def class_limits() -> np.ndarray:
    """Largest size of each class: half as much again from one to the next."""
    limits = [EQUAL_BELOW + 1]
    while limits[-1] < 1 << 40:
        limits.append(limits[-1] * 3 // 2 + 1)
    return np.array(limits)


LIMITS = class_limits()


def cells(hashes: np.ndarray) -> np.ndarray:
    """The cells of a set, given its sorted hashes."""
    n = len(hashes)
    if n < EQUAL_BELOW:
        return np.zeros(0, np.uint64)
    own = int(np.searchsorted(LIMITS, n))
    out = []
    for level in (own, own + 1):
        limit = int(LIMITS[level])
        if level > own and 10 * n < 8 * (int(LIMITS[own]) + 1):
            break
        most = 2 * limit // 9
        blocks = most + 3 + -(-3 * most // 100)
        block = (hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        with np.errstate(over="ignore"):
            content = np.add.reduceat(mix(hashes + np.uint64(level)), first)
            keys = mix(content + block[first] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))
        out.append(keys)
        differ = min(n // 4, most)
        if len(first) <= differ:  # blocks - differ <= empty blocks: they may be all that agrees
            out.append(mix(np.array([level], np.uint64)))
    return np.concatenate(out)


def sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and the set's fingerprint, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(text, width) for text in batch["text"].to_pylist()]
            marks = [fingerprint(s) for s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array([m[0] for m in marks], pa.int64()),
                    pa.array([m[1] for m in marks], pa.int64()),
                ],
                ["doc_id", "n_shingles", "mark", "mark2"],
            )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, mark bigint, mark2 bigint")


def all_cells(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(cell, doc_id) of every document; a task sends copies of a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        keys, owners, held = [], [], 0

        def flush() -> pa.RecordBatch:
            cell = np.concatenate(keys).view(np.int64)
            owner = np.repeat(np.array(owners, np.int64), [len(k) for k in keys])
            return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(owner)], ["cell", "doc_id"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                found = shingle_set(text, width)
                if doc_id is None or len(found) < EQUAL_BELOW:
                    continue
                mark = fingerprint(found)
                if mark in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(mark)
                keys.append(cells(found))
                owners.append(doc_id)
                held += len(keys[-1])
                if held >= HELD_CELLS:
                    yield flush()
                    keys, owners, held = [], [], 0
        if keys:
            yield flush()

    return docs.mapInArrow(run, "cell bigint, doc_id bigint")


def tree_pairs(counts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points (in the given order, i < j) whose bound allows a link.

    Nodes hold ``LEAF`` neighbours in the given order; per node the tree keeps its upper corner and its
    least size.
    """

    def allowed(corner: np.ndarray, least: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        bound = np.empty(len(i), np.int64)
        for at in range(0, len(i), CHUNK):
            part = slice(at, at + CHUNK)
            bound[part] = np.minimum(corner[i[part]], corner[j[part]]).sum(1, dtype=np.int64)
        return (100 + PERCENT) * bound >= PERCENT * (least[i] + least[j])

    levels = [(counts, sizes)]
    while len(levels[-1][1]) > 1:
        corner, least = levels[-1]
        first = np.arange(0, len(least), LEAF)
        levels.append((np.maximum.reduceat(corner, first, 0), np.minimum.reduceat(least, first)))

    def descend(level: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        corner, least = levels[level]
        keep = allowed(corner, least, i, j)
        i, j = i[keep], j[keep]
        if level == 0:
            yield i, j
            return
        count = len(levels[level - 1][1])
        child = np.arange(LEAF)
        step = max(1, CHUNK // (LEAF * LEAF))
        for at in range(0, len(i), step):
            a = (i[at : at + step, None, None] * LEAF + child[None, :, None]).repeat(LEAF, 2).ravel()
            b = (j[at : at + step, None, None] * LEAF + child[None, None, :]).repeat(LEAF, 1).ravel()
            inside = (a < count) & (b < count) & ((a < b) if level == 1 else (a <= b))
            yield from descend(level - 1, a[inside], b[inside])

    top = len(levels) - 1
    if top:
        yield from descend(top, np.zeros(1, np.int64), np.zeros(1, np.int64))


def links_of(hashes: list[np.ndarray]) -> list[tuple[int, int]]:
    """Verified links that span the connected sets (positions in the given order)."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    counts = np.stack([np.bincount((h % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS) for h in hashes])
    counts = counts.astype(np.uint16 if counts.max() < 1 << 16 else np.uint32)
    root = list(range(len(hashes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for left, right in tree_pairs(counts, sizes):
        for i, j in zip(left.tolist(), right.tolist()):
            a, b = find(i), find(j)
            if a == b:
                continue
            overlap = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
            if (100 + PERCENT) * overlap >= PERCENT * (int(sizes[i]) + int(sizes[j])):
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def candidate_groups(docs: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """(doc_id, hub): for every cell, its representatives under its smallest document.

    Cells with the same smallest document, the hub, make one group, so documents that share many
    cells are listed once. Two documents that share a cell are in the group of its hub.
    """
    hub = F.min("doc_id").over(Window.partitionBy("cell"))
    met = all_cells(docs, width).withColumn("hub", hub).filter("doc_id > hub").select("doc_id", "hub")
    met = stored(met.groupBy("doc_id", "hub").agg(F.count("*").alias("cells")), "met")
    rep = known.select(F.col("doc_id").alias("id"), "rep").distinct()
    pairs = met.join(rep, F.col("doc_id") == F.col("id")).select(F.col("rep").alias("doc_id"), "hub")
    pairs = stored(pairs, "met-a").join(rep, F.col("hub") == F.col("id")).select("doc_id", F.col("rep").alias("hub"))
    pairs = stored(pairs.filter("doc_id <> hub").distinct(), "met-b")
    return pairs.unionByName(pairs.select(F.col("hub").alias("doc_id"), "hub").distinct())


def tiled(groups: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, candidates, tiles): the tiles that a set takes part in, and its smallest group."""
    sizes = known.filter("doc_id = rep").select("doc_id", "n_shingles").distinct()
    sized = stored(groups.join(sizes, "doc_id"), "candidates")
    per_group = sized.groupBy("hub").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("shingles"))
    load = F.greatest(F.col("sets") / TILE_SETS, F.col("shingles") / TILE_SHINGLES)
    per_group = stored(per_group.select("hub", load.alias("load"), F.ceil(2 * load).alias("chunks")), "groups")
    small = F.col("load") <= 0.5
    total = per_group.filter(small).agg(F.coalesce(F.sum("load"), F.lit(0.0))).first()[0]
    shared = max(1, round(2 * total))
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    other = F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)
    pair = lambda o: F.concat_ws("-", F.lit("g"), "hub", F.least(chunk, o), F.greatest(chunk, o))
    tiles = F.when(small, F.array(F.concat_ws("-", F.lit("s"), F.pmod(F.xxhash64("hub"), F.lit(shared))))).otherwise(
        F.transform(other, pair)
    )
    placed = sized.join(per_group, "hub").select("doc_id", "hub", F.explode(tiles).alias("tile"))
    return placed.groupBy("doc_id").agg(F.min("hub").alias("candidates"), F.collect_set("tile").alias("tiles"))


def links(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """Verified links (a, b) that connect all linked representatives.

    Texts are sent to the tiles, as they are smaller than the hashes of their shingles.
    """

    def join_tile(group: pa.Table) -> pa.Table:
        found = [shingle_set(text, width) for text in group["text"].to_pylist()]
        ids, near = group["doc_id"].to_numpy(), group["candidates"].to_numpy()
        order = np.lexsort((ids, [len(f) for f in found], near))
        ids = ids[order]
        pairs = links_of([found[i] for i in order])
        a, b = (np.array([ids[pair[k]] for pair in pairs], np.int64) for k in (0, 1))
        return pa.table({"a": a, "b": b})

    once = docs.join(members, "doc_id").select("doc_id", "text", "candidates", F.explode("tiles").alias("tile"))
    return once.groupBy("tile").applyInArrow(join_tile, "a bigint, b bigint")


def classes(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    marked = stored(sets(texts, width), "sets")
    mark = ["n_shingles", "mark", "mark2"]
    copies = marked.filter("doc_id is not null and n_shingles > 0").groupBy(*mark)
    copies = stored(copies.agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).filter("rep < last").drop("last"), "copies")
    known = marked.join(copies, mark, "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    known = stored(known, "known")
    members = tiled(candidate_groups(texts, known, width), known)
    # Rows that share an id with different texts are one document: their sets are joined, too.
    same_id = known.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    joined = components(links(texts, members, width).unionByName(same_id))
    label = joined.select(F.col("node").alias("doc_id"), F.col("component"))
    return known.join(label, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows and columns of the document with the smallest id of each component, once.

    Rows without an id link with nothing and stay.
    """
    found = classes(docs, width)
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    kept = docs.join(stored(first, "kept"), F.col("doc_id").cast("bigint") == F.col("_kept_id"), "left_semi")
    return kept.dropDuplicates(["doc_id"]).unionByName(docs.filter("doc_id is null"))
