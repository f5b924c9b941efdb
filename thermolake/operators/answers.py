"""Cited extractive answers from reranked chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake import settings
from thermolake.functions.text import fingerprint, sentences, strip
from thermolake.operators.fusion import PairScorer, rerank
from thermolake.operators.topk import top_k

# The marker pattern and the reply without any candidate.
MARKER_PATTERN = r"\[Source (\d+)\]"
NO_ANSWER = "The retrieved context does not contain this information."

# Fixed value: the rules of the prompt. The role before them is our own and a parameter.
PROMPT_RULES = (
    "Answer ONLY from the context below. Cite every claim with the matching [Source N] marker. "
    "If the context does not contain the answer, reply exactly: "
    f"'{NO_ANSWER}'\n\n"
)
DEFAULT_ROLE = "Your task is to explain sensor readings to the people who run the machines. "


class UngroundedAnswer(AssertionError):
    """An answer cites a chunk that was not retrieved, or cites nothing."""


def marker(number: Column) -> Column:
    return F.format_string("[Source %d]", number)


def context(reranked: DataFrame) -> DataFrame:
    """Per query: the numbered context block and the citation of each chunk, in rank order.

    A query has a handful of reranked chunks, so collecting them per query is bounded.
    """
    items = F.sort_array(
        F.collect_list(F.struct("rank", "text", "chunk_id", "doc_id", "source"))
    )
    grouped = reranked.groupBy("query_id").agg(F.first("query").alias("query"), items.alias("_items"))
    return grouped.select(
        "query_id",
        "query",
        F.array_join(
            F.transform("_items", lambda c: F.concat(marker(c["rank"]), F.lit(" "), c["text"])), "\n\n"
        ).alias("context_block"),
        F.transform(
            "_items",
            lambda c: F.struct(
                marker(c["rank"]).alias("marker"),
                c["chunk_id"].alias("chunk_id"),
                c["doc_id"].alias("doc_id"),
                c["source"].alias("source"),
            ),
        ).alias("all_context_citations"),
    )


def prompt(query: Column, context_block: Column, role: str = DEFAULT_ROLE) -> Column:
    """The prompt as a column, for a model outside Spark."""
    return F.concat(
        F.lit(role + PROMPT_RULES + "CONTEXT:\n"),
        context_block,
        F.lit("\n\nQUESTION: "),
        query,
        F.lit("\n\nANSWER:"),
    )


def candidate_sentences(reranked: DataFrame) -> DataFrame:
    """Sentences of the retrieved chunks, each kept at its first occurrence.

    Chunks overlap, so a sentence may come twice; the best-ranked chunk keeps it.
    """
    split = reranked.select(
        "query_id",
        "query",
        F.col("rank").alias("chunk_rank"),
        "chunk_id",
        F.posexplode(sentences(F.col("text"))).alias("pos", "_sentence"),
    )
    stripped = split.withColumn("text", strip(F.col("_sentence"))).filter("text <> ''")
    first = top_k(
        stripped.withColumn("_print", fingerprint(F.col("text"))),
        ["query_id", "_print"],
        [F.asc("chunk_rank"), F.asc("pos")],
        1,
        "_first",
    )
    return first.select(
        "query_id",
        "query",
        "chunk_rank",
        "pos",
        "text",
        F.format_string("%s::%d", "chunk_id", "pos").alias("cand_id"),
    )


def cite(sentence: Column, mark: Column) -> Column:
    """The marker before a final period, or after the text."""
    body = F.rtrim(sentence)
    return F.when(
        body.endswith("."),
        F.concat(F.substring(body, F.lit(1), F.length(body) - 1), F.lit(" "), mark, F.lit(".")),
    ).otherwise(F.concat(body, F.lit(" "), mark))


def cited_numbers(text: Column) -> Column:
    """The numbers of the markers in a text, without leading zeros: ``[Source 02]`` cites 2."""
    digits = F.regexp_extract_all(text, F.lit(MARKER_PATTERN), F.lit(1))
    return F.transform(digits, lambda d: F.regexp_replace(d, "^0+(?=.)", ""))


def extractive_answers(
    reranked: DataFrame,
    queries: DataFrame,
    scorer: PairScorer,
    max_sentences: int = settings.MAX_SENTENCES,
) -> DataFrame:
    """One row per query: the answer, the citations it uses and whether it is grounded."""
    best = rerank(candidate_sentences(reranked), scorer, max_sentences, "chunk_rank", "pos")
    parts = F.sort_array(
        F.collect_list(
            F.struct("rank", cite(F.col("text"), marker(F.col("chunk_rank"))).alias("part"))
        )
    )
    composed = best.groupBy("query_id").agg(
        F.array_join(F.transform(parts, lambda p: p["part"]), " ").alias("answer")
    )
    contexts = context(reranked).drop("query")
    joined = (
        queries.select("query_id", "query")
        .join(contexts, "query_id", "left")
        .join(composed, "query_id", "left")
        .withColumn("answer", F.coalesce("answer", F.lit(NO_ANSWER)))
        .withColumn("_used", cited_numbers(F.col("answer")))
    )
    none = F.array().cast("array<struct<marker:string,chunk_id:string,doc_id:string,source:string>>")
    every = F.coalesce("all_context_citations", none)
    used = F.filter(
        every, lambda c: F.array_contains("_used", cited_numbers(c["marker"])[0])
    )
    return joined.select(
        "query_id",
        "query",
        F.lit("extractive").alias("backend"),
        "answer",
        used.alias("citations"),
        every.alias("all_context_citations"),
        F.transform(every, lambda c: c["chunk_id"]).alias("context_chunk_ids"),
        F.coalesce("context_block", F.lit("")).alias("context_block"),
    ).withColumn("grounded", F.size("citations") > 0)


def citation_audit(answers: DataFrame, reranked: DataFrame) -> DataFrame:
    """Problems: cited chunks that were not retrieved, and answers without a citation."""
    cited = answers.select("query_id", F.explode("citations.chunk_id").alias("chunk_id"))
    foreign = cited.join(reranked.select("query_id", "chunk_id"), ["query_id", "chunk_id"], "left_anti")
    bare = answers.filter(~F.col("grounded")).select("query_id", F.lit(None).cast("string").alias("chunk_id"))
    return foreign.withColumn("problem", F.lit("not retrieved")).unionByName(
        bare.withColumn("problem", F.lit("no citation"))
    )


def require_grounded(answers: DataFrame, reranked: DataFrame) -> None:
    examples = citation_audit(answers, reranked).take(5)
    if examples:
        raise UngroundedAnswer(str(examples))
