"""Score a large table against a block of queries and keep the best ``k`` rows per query.

The query block is broadcast after its size is checked; the table streams through Arrow batches
in whatever partitions it has. Each task keeps a running top ``k``, so what it sends on is at
most ``k`` rows per query: no (query, row) pair is ever materialised or shuffled, and no term,
cluster or source can become a hot group. Queries above the size bound are scored in several
blocks, one after the other: a block's hits are written and its broadcast is destroyed before the
next one is fetched, so the driver and the workers hold one block at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake import settings
from thermolake.operators.topk import top_k
from thermolake.session import materialise

# Scores are compared at this precision: copies of a text may differ in the last bits.
SCORE_DIGITS = 9
SLACK = 10.0 ** (1 - SCORE_DIGITS)

# Queries scored together: bounds a task's matrix to (rows of a batch) x this.
QUERIES_PER_MATRIX = 256

# ``score`` is rounded and decides the order; ``raw`` is what presentation rounds, once.
HIT_DDL = "query_id {}, id string, ord_key string, pos int, score double, raw double"

# Candidates a task lets gather before it merges them into what it keeps.
MERGE_ROWS = 10_000

# From a batch and the floor of every query (the k-th best score so far; it need not look for less):
# (number of the first query, rows x queries matrix, higher is better) per group; or, in place of the
# matrix, (row, query, score) of the pairs that count.
Scorer = Callable[[pa.RecordBatch, np.ndarray], Iterator[tuple[int, np.ndarray | tuple[np.ndarray, np.ndarray, np.ndarray]]]]


# What one of the best rows costs that a task keeps for a query.
KEPT_BYTES_PER_HIT = 512


def query_blocks(
    queries: DataFrame, size: Column, k: int, limit: int = settings.BROADCAST_LIMIT_BYTES
) -> Iterator[DataFrame]:
    """Split the queries by a hash of their id into blocks of about ``limit`` bytes, counting what a
    task keeps for each: ``k`` rows."""
    cost = F.greatest(size.cast("bigint"), F.lit(KEPT_BYTES_PER_HIT * k))
    total = queries.agg(F.sum(cost)).first()[0] or 0
    blocks = max(1, math.ceil(total / limit))
    if blocks == 1:
        yield queries
        return
    bucket = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    for number in range(blocks):
        yield queries.filter(bucket == number)


def search_blocks(
    blocks: Iterator[DataFrame],
    fetch: Callable[[DataFrame], tuple[list, object] | None],
    scorer: Callable[[object, list], Scorer],
    rows: DataFrame,
    k: int,
    columns: list[str],
    top: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """``HIT_DDL`` rows of all blocks: at most ``k`` per query and task, written block by block; or
    what ``top`` makes of a block in place of ``block_top_k``.

    ``fetch`` brings a block to the driver as (query ids, data to broadcast); ``scorer`` makes the
    scorer from what was broadcast, once per task.
    """
    spark = rows.sparkSession
    found = []
    for block in blocks:
        ids, data = fetch(block)
        if not ids:
            continue
        shared = spark.sparkContext.broadcast(data)
        partial = (top or block_top_k)(rows, ids, lambda shared=shared, ids=ids: scorer(shared.value, ids), k, columns)
        found.append(materialise(partial, "hits"))
        shared.destroy()
    if not found:
        return spark.createDataFrame([], HIT_DDL.format("bigint"))
    return reduce(DataFrame.unionByName, found)


def best_per_query(
    scores: np.ndarray, rank: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, query and rounded score of each query's best ``k`` scores not below its floor.

    ``scores`` is rows x queries; among equal rounded scores the lower ``rank`` wins. Scores of
    minus infinity never count.
    """
    n, width = scores.shape
    least = floor - SLACK
    mask = scores >= least
    if n > k and np.count_nonzero(mask) > 4 * k * width:
        mask = scores >= np.maximum(least, np.partition(scores, n - k, axis=0)[n - k] - SLACK)
    row, query = np.nonzero(mask)
    kept = best_pairs(row, query, scores[row, query], rank, floor, k)
    return row[kept], query[kept], np.round(scores[row[kept], query[kept]], SCORE_DIGITS)


def best_pairs(row: np.ndarray, query: np.ndarray, scores: np.ndarray, rank: np.ndarray, floor: np.ndarray, k: int) -> np.ndarray:
    """``best_per_query`` of single pairs: their numbers."""
    value = np.round(scores, SCORE_DIGITS)
    usable = np.flatnonzero((value >= floor[query]) & (value > -np.inf))
    order = usable[np.lexsort((rank[row[usable]], -value[usable], query[usable]))]
    place = np.arange(len(order)) - np.searchsorted(query[order], query[order], side="left")
    return order[place < k]


def block_top_k(
    rows: DataFrame,
    query_ids: list,
    scorer: Callable[[], Scorer],
    k: int,
    columns: list[str],
) -> DataFrame:
    """``HIT_DDL`` rows, at most ``k`` per query *and task*.

    ``rows`` holds ``id, ord_key, pos`` and the ``columns`` the scorer reads. ``scorer`` is called
    once per task.
    """

    def merge(pieces: list[pd.DataFrame], floor: np.ndarray) -> pd.DataFrame:
        """The best k of several pieces; raises the floor of queries that have k rows."""
        kept = pd.concat(pieces).sort_values(
            ["query", "score", "ord_key", "pos"], ascending=[True, False, True, True]
        )
        kept = kept[kept.groupby("query").cumcount() < k]
        full = kept.groupby("query")["score"].agg(["size", "min"])
        full = full[full["size"] == k]
        floor[full.index.to_numpy()] = full["min"].to_numpy()
        return kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        floor = np.full(len(query_ids), -np.inf)
        kept, fresh, waiting = None, [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.select(["id", "ord_key", "pos"]).to_pandas()
            rank = np.empty(len(keys), dtype=np.int64)
            rank[keys.sort_values(["ord_key", "pos"], kind="stable").index] = np.arange(len(keys))
            for start, scores in score(batch, floor):
                if isinstance(scores, tuple):
                    kept_pairs = best_pairs(*scores, rank, floor[start:], k)
                    row, query, raw = (x[kept_pairs] for x in scores)
                    value = np.round(raw, SCORE_DIGITS)
                else:
                    row, query, value = best_per_query(scores, rank, floor[start : start + scores.shape[1]], k)
                    raw = scores[row, query]
                if len(row):
                    fresh.append(keys.iloc[row].assign(query=query + start, score=value, raw=raw))
                    waiting += len(row)
            # Merging costs a sort of what is kept, so it waits until as much has come in.
            if fresh and (kept is None or waiting >= max(MERGE_ROWS, len(kept))):
                kept = merge(fresh if kept is None else [kept, *fresh], floor)
                fresh, waiting = [], 0
        if fresh:
            kept = merge(fresh if kept is None else [kept, *fresh], floor)
        if kept is not None and len(kept):
            ids = pa.array([query_ids[q] for q in kept["query"]], type=id_type)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(kept["id"], type=pa.string()),
                    pa.array(kept["ord_key"], type=pa.string()),
                    pa.array(kept["pos"], type=pa.int32()),
                    pa.array(kept["score"], type=pa.float64()),
                    pa.array(kept["raw"], type=pa.float64()),
                ],
                names=["query_id", "id", "ord_key", "pos", "score", "raw"],
            )

    id_type = pa.string() if any(isinstance(q, str) for q in query_ids) else pa.int64()
    ddl_type = "string" if id_type == pa.string() else "bigint"
    return rows.select("id", "ord_key", "pos", *columns).mapInArrow(
        run, HIT_DDL.format(ddl_type)
    )


def rank_hits(found: DataFrame, k: int) -> DataFrame:
    """Final ranking over all blocks' and tasks' candidates: best score, then corpus order."""
    return top_k(found, ["query_id"], [F.desc("score"), F.asc("ord_key"), F.asc("pos")], k)
