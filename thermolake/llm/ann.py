"""Approximate nearest neighbours: an HNSW graph per shard, shard results merged.

Vectors are dealt into shards of about ``SHARD_ROWS`` by a hash. A shard's graph is one row of flat
arrays: vectors, one int32 neighbour array per level (rows of fixed width, -1 for none) and the
entry node. Levels are drawn geometrically; a node's neighbours are chosen from its exact nearest
nodes of the level by the diversity rule (a candidate is skipped if it lies nearer to a chosen
neighbour), links are made in both directions, and full rows keep their nearest links by the same
rule. The shard size is fixed, so building takes time in proportion to the rows.

A search descends greedily through the upper levels and runs a beam of ``ef`` on the lowest one,
for all queries of a block in step. Queries are dealt into blocks; every (shard, block) pair is
one bounded task. Each shard's best are scored again in double precision and merged by
(distance, id).

Equal vectors are one node: it carries their smallest ids, as many as can be asked for, found by
a window that Spark limits before the shuffle. So copies, however many, fill no graph, and ties go
to smaller ids.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no
part, and neither do rows without an id; a repeated (id, vector) counts once; only vectors of equal
length are compared; a query's own id is never its neighbour; with fewer candidates than ``k`` all
are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermolake.llm.common import prepare, stored

SHARD_ROWS = 4_096
BLOCK_QUERIES = 1_024
# Links per node in the upper levels; the lowest has twice as many.
LINKS = 16
# Nearest nodes that links are chosen from.
EF_BUILD = 96
# Width of the beam.
EF_SEARCH = 128

INDEX_DDL = (
    "shard bigint, width int, nodes int, ids binary, id_counts binary, vectors binary, "
    "level_nodes array<binary>, level_links array<binary>, entry int"
)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows of a and b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def diverse(candidates: np.ndarray, near: np.ndarray, vectors: np.ndarray, links: int) -> list[int]:
    """Up to ``links`` of the candidates (nearest first), skipping what a chosen one already covers."""
    between = distances(vectors[candidates], vectors[candidates])
    chosen: list[int] = []
    skipped: list[int] = []
    for i in range(len(candidates)):
        if len(chosen) == links:
            break
        if chosen and between[i, chosen].min() < near[i]:
            skipped.append(i)
        else:
            chosen.append(i)
    chosen += skipped[: links - len(chosen)]
    return candidates[chosen].tolist()


def level_links(vectors: np.ndarray, nodes: np.ndarray, width: int) -> np.ndarray:
    """Neighbour rows (positions in ``nodes``) of one level."""
    n = len(nodes)
    own = vectors[nodes]
    near_count = min(n - 1, EF_BUILD)
    links: list[list[int]] = [[] for _ in range(n)]
    if near_count:
        for at in range(0, n, 512):
            block = distances(own[at : at + 512], own)
            block[np.arange(len(block)), np.arange(at, at + len(block))] = np.inf
            near = np.argpartition(block, near_count - 1, 1)[:, :near_count]
            far = np.take_along_axis(block, near, 1)
            order = np.argsort(far, 1, kind="stable")
            near, far = np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1)
            for i in range(len(block)):
                links[at + i] = diverse(near[i], far[i], own, width // 2)
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(links):
        for j in row:
            back[j].append(i)
    out = np.full((n, width), -1, np.int32)
    for i in range(n):
        row = list(dict.fromkeys(links[i] + back[i]))
        if len(row) > width:
            candidates = np.array(row)
            far = distances(own[i : i + 1], own[candidates])[0]
            order = np.argsort(far, kind="stable")
            row = diverse(candidates[order], far[order], own, width)
        out[i, : len(row)] = row
    return out


class Graph:
    """A shard's graph over its distinct vectors."""

    def __init__(self, vectors: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray], entry: int):
        self.vectors, self.nodes, self.links, self.entry = vectors, nodes, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> Graph:
        n = len(vectors)
        height = (-np.log(1 - np.random.default_rng(seed).random(n)) / math.log(LINKS)).astype(int)
        nodes, links = [], []
        for level in range(int(height.max()) + 1):
            members = np.flatnonzero(height >= level).astype(np.int32)
            nodes.append(members)
            links.append(level_links(vectors, members, LINKS if level else 2 * LINKS))
        return cls(vectors, nodes, links, int(nodes[-1][0]))

    def search(self, queries: np.ndarray, ef: int = EF_SEARCH) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances) per query, nearest first; -1 and inf where fewer were found."""
        entry = np.full(len(queries), self.entry, np.int64)
        for level in range(len(self.links) - 1, 0, -1):
            entry = self._descend(queries, entry, level)
        return self._beam(queries, entry, min(ef, len(self.vectors)))

    def _far(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its own row of nodes; inf for -1."""
        gap = self.vectors[nodes] - queries[:, None, :]
        return np.where(nodes < 0, np.inf, np.einsum("qnd,qnd->qn", gap, gap))

    def _descend(self, queries: np.ndarray, entry: np.ndarray, level: int) -> np.ndarray:
        place = np.full(len(self.vectors), -1, np.int64)
        place[self.nodes[level]] = np.arange(len(self.nodes[level]))
        best = self._far(queries, entry[:, None])[:, 0]
        active = np.arange(len(queries))
        while len(active):
            row = self.links[level][place[entry[active]]]
            near = np.where(row < 0, -1, self.nodes[level][row])
            far = self._far(queries[active], near)
            pick = far.argmin(1)
            least = far[np.arange(len(active)), pick]
            better = least < best[active]
            active, pick = active[better], pick[better]
            entry[active], best[active] = near[better, pick], least[better]
        return entry

    def _beam(self, queries: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        q, n = len(queries), len(self.vectors)
        rows = np.arange(q)[:, None]
        found = np.full((q, ef), -1, np.int64)
        far = np.full((q, ef), np.inf, np.float32)
        open_ = np.zeros((q, ef), bool)
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True  # where -1 points
        found[:, 0], far[:, 0], open_[:, 0] = entry, self._far(queries, entry[:, None])[:, 0], True
        seen[rows[:, 0], entry] = True
        while True:
            waiting = np.where(open_, far, np.inf)
            pick = waiting.argmin(1)
            active = np.flatnonzero(np.isfinite(waiting[rows[:, 0], pick]))
            if not len(active):
                # The graph may fall apart: go on from an unseen node while there is room.
                short = np.flatnonzero((found < 0).any(1))
                if not len(short):
                    return found, far
                start = (~seen[short, :n]).argmax(1)
                fresh = ~seen[short, start]
                short, start = short[fresh], start[fresh]
                if not len(short):
                    return found, far
                hole = (found[short] < 0).argmax(1)
                found[short, hole] = start
                far[short, hole] = self._far(queries[short], start[:, None])[:, 0]
                open_[short, hole] = True
                seen[short, start] = True
                continue
            pick = pick[active]
            open_[active, pick] = False
            near = self.links[0][found[active, pick]].astype(np.int64)
            near[seen[active[:, None], near]] = -1
            seen[active[:, None], near] = True
            near_far = self._far(queries[active], near).astype(np.float32)
            all_found = np.concatenate([found[active], near], 1)
            all_far = np.concatenate([far[active], near_far], 1)
            all_open = np.concatenate([open_[active], near >= 0], 1)
            order = np.argsort(all_far, 1, kind="stable")[:, :ef]
            found[active] = np.take_along_axis(all_found, order, 1)
            far[active] = np.take_along_axis(all_far, order, 1)
            open_[active] = np.take_along_axis(all_open, order, 1)


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, and not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def prepared(vectors: DataFrame) -> DataFrame:
    """Rows (id, vector) that take part, each once."""
    rows = vectors.select(F.col("id").cast("bigint"), F.col("vector").cast("array<double>"))
    # -0.0 and 0.0 are one value.
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    return rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))


def build(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of rows (id, vector): one row of flat arrays per shard."""
    spark = prepare(vectors.sparkSession)
    # A vector's k + 1 smallest ids are all that a search for k others can return. Copies are told
    # by two hashes and the vector itself is kept once; a window would sort whole vectors.
    same = [F.xxhash64("vector"), F.hash("vector"), F.size("vector")]
    rows = prepared(vectors).withColumns(dict(zip(("h", "g", "width"), same)))
    rank = F.dense_rank().over(Window.partitionBy("h", "g", "width").orderBy("id"))
    kept = rows.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    nodes = stored(
        kept.groupBy("h", "g", "width").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_set("id")).alias("ids")),
        "ann-nodes",
    )
    shards = {r["width"]: max(1, math.ceil(r["n"] / shard_rows)) for r in nodes.groupBy("width").agg(F.count("*").alias("n")).collect()}
    count = F.coalesce(*[F.when(F.col("width") == w, F.lit(n)) for w, n in shards.items()], F.lit(1))
    dealt = nodes.select(F.pmod("h", count).alias("shard"), "width", "vector", "ids", "h")

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("h", "ascending")])  # the same graph whatever order rows came in
        shard, width = (k.as_py() for k in key)
        values = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        exact = values.reshape(-1, width)
        graph = Graph.build(exact.astype(np.float32), seed=shard)
        ids = group["ids"].combine_chunks()
        return pa.Table.from_pydict(
            {
                "shard": [shard],
                "width": pa.array([width], pa.int32()),
                "nodes": pa.array([len(exact)], pa.int32()),
                "ids": [ids.flatten().to_numpy().astype("<i8").tobytes()],
                "id_counts": [np.diff(ids.offsets.to_numpy()).astype("<i4").tobytes()],
                "vectors": [exact.astype("<f8").tobytes()],
                "level_nodes": [[a.astype("<i4").tobytes() for a in graph.nodes]],
                "level_links": [[a.astype("<i4").tobytes() for a in graph.links]],
                "entry": pa.array([graph.entry], pa.int32()),
            }
        )

    return stored(dealt.groupBy("shard", "width").applyInArrow(run, INDEX_DDL), "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int, ef: int = EF_SEARCH, block: int = BLOCK_QUERIES) -> DataFrame:
    """For each query row (id, vector): its ``k`` nearest found, as query_id, rank, id, score.

    Of an id with several vectors the least one is asked, component by component.
    """
    spark = prepare(index.sparkSession)
    one = prepared(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = stored(one.withColumn("width", F.size("vector")), "ann-queries")
    blocks = max(1, math.ceil(asked.count() / block))
    shards = index.select(F.col("shard").alias("to_shard"), "width")
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    # Both sides of a (shard, block) pair are bounded: one index row, about ``block`` queries.
    to_shards = dealt.join(shards, "width").select(
        F.col("to_shard").alias("shard"), (F.col("width") + 0).alias("width"), "block", "id", "vector"
    )
    to_blocks = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))

    def run(key: tuple, shard: pa.Table, group: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not shard.num_rows or not group.num_rows:
            return pa.table(empty)
        row = shard.to_pylist()[0]
        width = row["width"]
        exact = np.frombuffer(row["vectors"], "<f8").reshape(-1, width)
        ids, counts = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["id_counts"], "<i4")
        nodes = [np.frombuffer(b, "<i4") for b in row["level_nodes"]]
        links = [np.frombuffer(b, "<i4").reshape(len(m), -1) for m, b in zip(nodes, row["level_links"])]
        graph = Graph(exact.astype(np.float32), nodes, links, row["entry"])
        query_ids = group["id"].to_numpy()
        points = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        found, _ = graph.search(points.astype(np.float32), max(ef, 2 * k))
        firsts = np.cumsum(counts) - counts
        out: tuple[list, list, list] = ([], [], [])
        for query, point, near in zip(query_ids, points, found):
            near = near[near >= 0]
            score = np.sqrt(((exact[near] - point) ** 2).sum(1))
            node = np.repeat(np.arange(len(near)), counts[near])
            member = ids[np.concatenate([np.arange(firsts[i], firsts[i] + counts[i]) for i in near])]
            score = score[node]
            best = np.lexsort((member, score))
            best = best[member[best] != query][:k]
            for column, values in zip(out, (np.full(len(best), query), member[best], score[best])):
                column.append(values)
        return pa.table(dict(zip(empty, map(np.concatenate, out))))

    keys = ["shard", "width", "block"]
    found = to_blocks.groupBy(*keys).cogroup(to_shards.groupBy(*keys)).applyInArrow(run, "query_id bigint, id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
