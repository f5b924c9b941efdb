"""The stages as jobs: Bronze, Silver, Gold behind the gate, and answered questions.

Streaming ingestion is ``streaming.ingest.ingest``. Each job publishes only after its audits have passed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake import settings
from thermolake.operators import answers as A
from thermolake.operators import bm25 as B
from thermolake.operators import dense as V
from thermolake.operators import fusion as X
from thermolake.operators import incremental as N
from thermolake.operators import medallion as M
from thermolake.operators import quality as Q
from thermolake.operators.corpus import chunk, kpi_documents, union_corpora
from thermolake.session import checkpoint_dir, materialise
from thermolake.sources.files import read_accepted, write_report
from thermolake.sources.tables import KeyedTable, check_schema, with_required


_OF_BRONZE = {f.name: f.dataType for f in M.BRONZE_SCHEMA}
VERSION_SCHEMA = T.StructType([T.StructField(n, _OF_BRONZE[n]) for n in (M.BUSINESS_KEY, *N.VERSION_COLUMNS)])


def append_bronze(spark: SparkSession, accepted: str, out: str, batch_id: int) -> int:
    """Append a batch of accepted JSON lines to the Bronze folder ``ingest`` writes.

    The batch has its own partition, so a repeated call replaces instead of duplicating it.
    Raises when the input is missing, empty or broken. Returns the number of rows.
    """
    rows = M.bronze(read_accepted(spark, accepted))
    check_schema(rows, M.BRONZE_SCHEMA)
    folder = f"{out}/bronze/ingest_batch={batch_id}"
    with_required(rows, M.BRONZE_SCHEMA).write.mode("overwrite").parquet(folder)
    return spark.read.schema(M.BRONZE_SCHEMA).parquet(folder).count()


def refresh_silver(
    table: KeyedTable, bronze: DataFrame, new_rows: DataFrame | None = None
) -> dict:
    """Upsert the cleaned Bronze rows; with ``new_rows``, only the keys these touch."""
    cleaned = M.clean(bronze) if new_rows is None else M.clean_touched(bronze, new_rows)
    return table.upsert(cleaned, M.BUSINESS_KEY)


def refresh_silver_by_versions(table: KeyedTable, versions: KeyedTable, batch: DataFrame) -> dict:
    """Upsert what a batch of deliveries replaces, without a look at Bronze.

    ``versions`` (``VERSION_SCHEMA``) knows the delivery that counts of every key. Silver goes first: if
    the job stops in between, a repeated batch finds the same rows again.
    """
    known = versions.read() if versions.exists() else table.spark.createDataFrame([], VERSION_SCHEMA)
    newer = materialise(N.newer_deliveries(batch, known), "newer")
    done = table.upsert(M.clean(newer), M.BUSINESS_KEY)
    versions.upsert(newer.select(VERSION_SCHEMA.names), M.BUSINESS_KEY)
    return done


def refresh_gold(
    silver: DataFrame,
    table: KeyedTable,
    checks: Sequence[Q.Check] | None = None,
    evidence: str | None = None,
) -> dict:
    """Rebuild Gold. The snapshot is written, checked and only then published, so a failed gate
    leaves readers, and every later stage, on the previous one."""
    checks = Q.gold_suite() if checks is None else checks

    def audit(gold: DataFrame) -> None:
        M.require_reduction(silver, gold)
        Q.run_gate(gold, checks, evidence)

    return table.overwrite(M.daily_kpis(silver), audit=audit)


def build_corpus(static: DataFrame, gold: KeyedTable | None = None) -> DataFrame:
    """Static documents, followed by one per KPI row once Gold has been published."""
    if gold is None or not gold.exists():
        return union_corpora(static)
    return union_corpora(static, kpi_documents(gold.read()))


def answer_questions(
    corpus: DataFrame,
    questions: DataFrame,
    index_path: str,
    evidence: str | None = None,
    embedder: Callable[[str], Callable[[DataFrame], DataFrame]] | None = None,
    scorer: X.PairScorer | None = None,
    top_k_retrieve: int = settings.TOP_K_RETRIEVE,
    top_k_final: int = settings.TOP_K_FINAL,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Index a corpus, run the funnel for all questions at once and answer them with citations.

    ``embedder`` maps a text column name to a function adding ``embedding``. Raises when an answer
    is not grounded; the evidence (stages and answers) is written first.
    """
    checkpoint_dir(corpus.sparkSession)
    embedder = embedder or (lambda text: V.hashing_embedder(text=text))
    index = B.TextIndex.build(chunk(corpus), index_path, embed=embedder("text"))
    scorer = scorer or X.idf_overlap(questions, index.terms())
    vectors = embedder("query")(questions).select("query_id", "embedding")
    stages = X.funnel(
        V.dense_hits(V.dense_search(index.chunks(), vectors, top_k_retrieve)),
        B.bm25_hits(B.bm25_search(index, questions, top_k_retrieve)),
        questions,
        index.chunks(),
        scorer,
        top_k_retrieve,
        top_k_final,
    )
    answers = A.extractive_answers(stages["reranked"], questions, scorer).checkpoint()
    if evidence is not None:
        write_report(X.summarise_funnel(stages, index.chunks()), f"{evidence}/stages")
        write_report(answers.withColumn("answered_at", F.current_timestamp()), f"{evidence}/answers")
    A.require_grounded(answers, stages["reranked"])
    return answers, stages
