"""Rank fusion, reranking and the retrieval funnel over many queries at once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake import settings
from thermolake.functions.text import tokens
from thermolake.operators.topk import top_k
from thermolake.session import materialise

FUNNEL_COLUMNS = ["query_id", "stage", "rank", "chunk_id", "score", "retrieved_by", "source"]

# A scorer takes (query_id, cand_id, query, text) rows and returns them with ``score``.
PairScorer = Callable[[DataFrame], DataFrame]


def reciprocal_rank_fusion(
    dense: DataFrame,
    keyword: DataFrame,
    k: int = settings.RRF_K,
    limit: int = settings.TOP_K_RETRIEVE,
) -> DataFrame:
    """``sum 1 / (k + rank)`` over two ranked lists (``query_id, rank, chunk_id``).

    Equal sums keep the dense list's order first, then the keyword list's.
    """
    lists = dense.select("query_id", "chunk_id", "rank", F.lit("dense").alias("_by")).unionByName(
        keyword.select("query_id", "chunk_id", "rank", F.lit("bm25").alias("_by"))
    )
    ranks = lists.groupBy("query_id", "chunk_id").agg(
        F.min(F.when(F.col("_by") == "dense", F.col("rank"))).alias("_dense"),
        F.min(F.when(F.col("_by") == "bm25", F.col("rank"))).alias("_bm25"),
    )

    def share(rank: str) -> Column:
        return F.coalesce(F.lit(1.0) / (F.col(rank) + k), F.lit(0.0))

    def label(name: str, rank: str) -> Column:
        return F.when(F.col(rank).isNotNull(), F.concat(F.lit(f"{name}@"), F.col(rank)))

    scored = ranks.select(
        "query_id",
        "chunk_id",
        (share("_dense") + share("_bm25")).alias("score"),
        F.array_compact(F.array(label("dense", "_dense"), label("bm25", "_bm25"))).alias("retrieved_by"),
        "_dense",
        "_bm25",
    )
    order = [F.desc("score"), F.asc_nulls_last("_dense"), F.asc_nulls_last("_bm25")]
    return top_k(scored, ["query_id"], order, limit).select(
        "query_id", "rank", "chunk_id", F.round("score", 6).alias("rrf_score"), "retrieved_by"
    )


def idf_overlap(queries: DataFrame, terms: DataFrame) -> PairScorer:
    """Default pair scorer: summed idf of the distinct words a text shares with the query.

    It stands in for a cross-encoder. ``terms`` is the index's ``(term, df, idf)`` table. The
    queries' words pick their idf from it once; the result is written and serves every call.
    """
    words = queries.select(
        "query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term")
    )
    weights = materialise(terms.select("term", "idf").join(materialise(words, "words"), "term"), "weights")

    def score(pairs: DataFrame) -> DataFrame:
        sums = (
            pairs.select(
                "query_id", "cand_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term")
            )
            .join(weights, ["query_id", "term"])
            .groupBy("query_id", "cand_id")
            .agg(F.round(F.sum("idf"), 9).alias("score"))
        )
        return pairs.join(sums, ["query_id", "cand_id"], "left").fillna(0.0, subset=["score"])

    return score


def column_scorer(score: Callable[[Column, Column], Column]) -> PairScorer:
    """A scorer from a function of (query, text) columns, for instance a ``pandas_udf`` that loads
    its model once per Python worker and scores Arrow batches."""
    return lambda pairs: pairs.withColumn("score", score(F.col("query"), F.col("text")))


def rerank(candidates: DataFrame, scorer: PairScorer, k: int, *order: str) -> DataFrame:
    """Best ``k`` candidates (``query_id, cand_id, query, text``) per query by pair score.

    Equal scores keep the input order, given by the ``order`` columns (``rank`` by default).
    """
    ties = [F.asc(column) for column in order or ("rank",)]
    return top_k(scorer(candidates), ["query_id"], [F.desc("score"), *ties], k)


def with_chunk(hits: DataFrame, chunks: DataFrame, *columns: str) -> DataFrame:
    """Attach chunk columns to hits. Spark broadcasts hits that were written before if they are
    small enough, and then reads the chunk table in place."""
    return chunks.select(F.col("id").alias("chunk_id"), *columns).join(hits, "chunk_id")


def funnel(
    dense: DataFrame,
    keyword: DataFrame,
    queries: DataFrame,
    chunks: DataFrame,
    scorer: PairScorer,
    top_k_retrieve: int = settings.TOP_K_RETRIEVE,
    top_k_final: int = settings.TOP_K_FINAL,
) -> dict[str, DataFrame]:
    """All four stages per query: ``dense``, ``bm25``, ``fused``, ``reranked``.

    The searches have written their hits; what joins the chunk table is written once more, as
    several stages read it. Reranking stays lazy.
    """
    fused = materialise(reciprocal_rank_fusion(dense, keyword, limit=top_k_retrieve), "fused")
    candidates = materialise(with_chunk(fused, chunks, "text", "source", "doc_id"), "candidates").join(queries, "query_id")
    reranked = rerank(candidates.withColumn("cand_id", F.col("chunk_id")), scorer, top_k_final)
    reranked = reranked.select(
        "query_id", "rank", "chunk_id", "score", "text", "source", "doc_id", "query"
    )
    return {"dense": dense, "bm25": keyword, "fused": fused, "reranked": reranked}


def summarise_funnel(stages: dict[str, DataFrame], chunks: DataFrame) -> DataFrame:
    """The stages as one long table (``FUNNEL_COLUMNS``); each hit with the source of its chunk."""
    none = F.lit(None).cast("string")
    scores = {
        "dense": ("distance", none),
        "bm25": ("bm25_score", none),
        "fused": ("rrf_score", F.array_join("retrieved_by", ",")),
        "reranked": ("score", none),
    }
    parts = []
    for name, (score, provenance) in scores.items():
        value = F.round(score, 4) if name == "reranked" else F.col(score)
        parts.append(
            stages[name].select(
                "query_id",
                F.lit(name).alias("stage"),
                "rank",
                "chunk_id",
                value.alias("score"),
                provenance.alias("retrieved_by"),
            )
        )
    hits = materialise(reduce(DataFrame.unionByName, parts), "stages")
    return with_chunk(hits, chunks, "source").select(FUNNEL_COLUMNS)
