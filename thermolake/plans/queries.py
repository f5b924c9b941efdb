"""The registered queries: engine operators over whole tables.

Dates and instants are returned as text and arrays joined, so that any client compares them alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake.operators import answers as A
from thermolake.operators import bm25 as B
from thermolake.operators import contract as C
from thermolake.operators import corpus as D
from thermolake.operators import dense as V
from thermolake.operators import fusion as X
from thermolake.operators import incremental as N
from thermolake.operators import medallion as M
from thermolake.operators import quality as Q
from thermolake.operators import runlog as R
from thermolake.operators import upsert as U
from thermolake.plans import inputs as I
from thermolake.plans import jobs
from thermolake.session import checkpoint_dir, configure, materialise
from thermolake.sources.files import write_json_lines
from thermolake.sources.tables import KeyedTable, SchemaMismatch, check_schema, write_for_lookup
from thermolake.streaming.ingest import read_bronze

Query = Callable[[SparkSession, str], DataFrame]


def instant(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def day(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def presentable(rows: DataFrame) -> DataFrame:
    """Timestamps and dates as text."""
    out = []
    for field in rows.schema:
        if isinstance(field.dataType, T.TimestampType):
            out.append(instant(field.name))
        elif isinstance(field.dataType, T.DateType):
            out.append(day(field.name))
        else:
            out.append(F.col(field.name))
    return rows.select(*out)


# --- contract -----------------------------------------------------------------------------


def contract_accepted(spark, sf):
    return presentable(C.accepted(I.checked_topic(spark, sf)))


def contract_rejected(spark, sf):
    checked = I.checked_topic(spark, sf)
    texts = F.array_sort(F.transform("errors", lambda e: F.concat_ws(": ", e["field"], e["error"])))
    return checked.filter(F.col("rejection_reason").isNotNull()).select(
        F.col("offset").alias("kafka_offset"),
        "rejection_reason",
        F.array_join(texts, "; ").alias("problems"),
    )


def dead_letters(spark, sf):
    letters = C.dead_letters(I.checked_topic(spark, sf), "readings")
    return letters.select(
        "source_topic", "rejection_reason", F.size("validation_error").alias("errors"), "original_payload"
    )


def contract_error_counts(spark, sf):
    return C.error_counts(I.checked_topic(spark, sf))


def contract_routing_counts(spark, sf):
    return C.routing_counts(I.checked_topic(spark, sf))


# --- bronze, silver, gold -----------------------------------------------------------------


def bronze_rows(spark, sf):
    """Contract, accepted JSON lines, their checks, and the Bronze append."""
    return presentable(M.bronze(I.accepted(spark, sf), I.delivered_at()))


def silver_latest(spark, sf):
    return presentable(I.silver(spark, sf))


def silver_status(spark, sf):
    rows = I.silver(spark, sf).groupBy("status", "is_anomaly")
    return rows.agg(F.count(F.lit(1)).alias("readings"))


def silver_touched(spark, sf):
    return presentable(M.clean_touched(I.deliveries(spark, sf), I.corrections(spark, sf)))


def _changes(spark, sf) -> DataFrame:
    """The change batch, written once, as it is read twice."""
    return materialise(I.silver_changes(spark, sf), "changes")


def silver_incremental(spark, sf):
    """The Silver rows a batch changes, from stored versions: late deliveries of other readings, older
    than what is known of them, change nothing."""
    known = materialise(N.versions(I.readings(spark, sf)), "versions")
    earlier = F.col("ingested_at") - F.expr("INTERVAL 10 MINUTES")
    late = I.readings(spark, sf).filter("event_type = 'signup'").withColumn("ingested_at", earlier)
    batch = I.corrections(spark, sf).unionByName(late.withColumn("temperature_c", F.lit(0.0)))
    return presentable(M.clean(N.newer_deliveries(batch.select(M.BRONZE_SCHEMA.names), known)))


def bronze_appended(spark, sf):
    """Accepted JSON lines appended to Bronze twice under one batch id, which leaves them there once."""
    folder = _folder(spark, "append")
    write_json_lines(I.accepted(spark, sf), f"{folder}/accepted")
    for _ in range(2):
        jobs.append_bronze(spark, f"{folder}/accepted", folder, 1)
    return presentable(read_bronze(spark, folder).select(M.ACCEPTED_SCHEMA.names))


def gold_overwritten(spark, sf):
    """Gold written twice: the second overwrite replaces the first."""
    table = _table(spark, "gold", M.GOLD_SCHEMA)
    table.overwrite(M.daily_kpis(I.silver(spark, sf)))
    table.overwrite(I.gold(spark, sf), audit=lambda rows: M.require_reduction(I.first_silver(spark, sf), rows))
    return presentable(table.read().withColumn("operations", F.lit(table.history().count())))


def silver_upsert(spark, sf):
    merged = U.upsert(I.first_silver(spark, sf), _changes(spark, sf), "reading_id")
    return presentable(merged)


def upsert_metrics(spark, sf):
    return U.upsert_metrics(I.first_silver(spark, sf), _changes(spark, sf), "reading_id")


def upsert_diff(spark, sf):
    """What the change batch changes, from the rows it touches."""
    before = I.first_silver(spark, sf)
    return U.change_diff(before, _changes(spark, sf), "reading_id", ["temperature_c", "status"])


def distinct_keys(spark, sf):
    return M.distinct_keys(I.deliveries(spark, sf))


def key_lookup(spark, sf):
    """One reading in Bronze stored for lookups: one row group is read."""
    stored = write_for_lookup(M.bronze(I.accepted(spark, sf), I.delivered_at()), M.BUSINESS_KEY, _folder(spark, "lookup"))
    return presentable(M.lookup(stored, "7"))


def distinct_keys_by_range(spark, sf):
    """Distinct readings per week: exact, and whether the merged sketches of its days are within 6 %."""
    rows = I.deliveries(spark, sf)
    sketches = materialise(N.key_sketches(rows, F.col("recorded_at").cast("date")), "sketches")
    week = lambda c: F.date_format(F.date_trunc("week", c), "yyyy-MM-dd")
    estimated = N.distinct_of(sketches, week(F.col("part")))
    exact = rows.groupBy(week(F.col("recorded_at")).alias("part")).agg(F.countDistinct("reading_id").alias("exact"))
    near = F.abs(F.col("distinct_keys") - F.col("exact")) <= 0.06 * F.col("exact")
    return exact.join(estimated, "part").select(F.col("part").alias("week"), "exact", near.alias("within"))


def _last_days(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver before and after the corrections of the latest three days, and the changed rows."""
    before, corrections = materialise(I.first_silver(spark, sf), "before"), I.corrections(spark, sf)
    days = F.col("recorded_at").cast("date")
    since = corrections.select(F.date_sub(F.max(days), 2).alias("since"))
    batch = corrections.join(F.broadcast(since), days >= F.col("since")).drop("since")  # one row
    changes = materialise(M.clean(batch), "changes")
    return before, materialise(U.upsert(before, changes, "reading_id"), "after"), changes


def kpi_after_changes(spark, sf):
    """Gold brought up to date from stored partials and the rows a batch replaces and adds."""
    before, changes = materialise(I.first_silver(spark, sf), "before"), _changes(spark, sf)
    partials = materialise(M.kpi_partials(before), "partials")
    after = U.upsert(before, changes, "reading_id")
    removed = before.join(changes.select("reading_id"), "reading_id", "left_semi")
    new, gone = N.partials_after(partials, removed, changes, after)
    return presentable(M.kpis(N.replace_groups(partials, materialise(new, "new"), gone, N.GROUP)))


def unchanged_days(spark, sf):
    """Days whose rows an upsert left as they were, by comparing fingerprints."""
    before, after, _ = _last_days(spark, sf)
    now = N.fingerprints(after, "reading_date")
    changed = N.differing(N.fingerprints(before, "reading_date"), now, "reading_date")
    return presentable(now.select("reading_date", F.col("n").alias("readings")).join(changed, "reading_date", "left_anti"))


def gate_incremental(spark, sf):
    """The gate's report from stored states, of which only those of changed days are computed again."""
    before, after, changes = _last_days(spark, sf)
    states = materialise(N.check_states(M.daily_kpis(before), _suite(), "reading_date"), "states")
    days = changes.select("reading_date").distinct()
    gold = M.daily_kpis(after.join(days, "reading_date", "left_semi"))
    new = materialise(N.check_states(gold, _suite(), "reading_date"), "new")
    return N.report_of_states(N.replace_groups(states, new, days, ["reading_date"]), gold, _suite())


def kpi_daily(spark, sf):
    return presentable(I.gold(spark, sf))


def kpi_reduction_check(spark, sf):
    return M.reduction_check(I.first_silver(spark, sf), I.gold(spark, sf))


def schema_check(spark, sf):
    """Silver rows with a text temperature: refused, next to the untouched row count."""
    wrong = I.first_silver(spark, sf).withColumn("temperature_c", F.col("temperature_c").cast("string"))
    try:
        check_schema(wrong, M.SILVER_SCHEMA)
        problem = None
    except SchemaMismatch as exc:
        problem = str(exc)
    return wrong.agg(F.count(F.lit(1)).alias("rows_refused")).withColumn("problem", F.lit(problem))


# --- quality ------------------------------------------------------------------------------


def _suite() -> list[Q.Check]:
    return Q.gold_suite(I.GATE_MACHINES)


def _written_gold(spark, sf) -> DataFrame:
    """Gold as the gate sees it: already written, not yet published."""
    return materialise(I.gold(spark, sf), "gold")


def gate_report(spark, sf):
    return Q.evaluate(_written_gold(spark, sf), _suite())


def gate_summary(spark, sf):
    rows = _written_gold(spark, sf)
    return Q.summarise(Q.evaluate(rows, _suite()), rows, _suite())


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/thermolake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _table(spark, name: str, schema: T.StructType, partition_by: str | None = None) -> KeyedTable:
    """A new table of the catalog with its files in the shared folder."""
    unique = f"{name}_{uuid.uuid4().hex}"
    folder = f"{checkpoint_dir(spark)}/thermolake/{spark.sparkContext.applicationId}/{unique}"
    return KeyedTable(spark, unique, schema, partition_by, folder)


def silver_rewritten(spark, sf):
    """An upsert of the corrections of the latest three days into a table by day: rows of each day, and
    whether its files were rewritten."""
    table = _table(spark, "silver", M.SILVER_SCHEMA, "reading_date")
    table.create(I.first_silver(spark, sf))
    files = lambda: spark.table(table.name).select("reading_date", F.input_file_name().alias("file")).distinct()
    before = materialise(files(), "files").withColumn("old", F.lit(True))
    days = F.col("recorded_at").cast("date")
    corrections = I.corrections(spark, sf)
    last = corrections.select(F.date_sub(F.max(days), 2).alias("since"))
    table.upsert(M.clean(corrections.join(F.broadcast(last), days >= F.col("since")).drop("since")), "reading_id")
    same = files().join(before, ["reading_date", "file"], "left").groupBy("reading_date")
    same = same.agg((~F.coalesce(F.max("old"), F.lit(False))).alias("rewritten"))
    days = table.read().groupBy("reading_date").agg(F.count(F.lit(1)).alias("readings"))
    return presentable(days.join(same, "reading_date"))


def rejected_write(spark, sf):
    """A write of a wrong type is refused and changes neither rows nor history."""
    table = _table(spark, "silver", M.SILVER_SCHEMA)
    table.create(I.first_silver(spark, sf))
    wrong = table.read().withColumn("temperature_c", F.col("temperature_c").cast("string"))
    try:
        table.overwrite(wrong)
        problem = None
    except SchemaMismatch as exc:
        problem = str(exc)
    state = [(problem, table.read().count(), table.history().count())]
    return spark.createDataFrame(state, "problem string, rows_after bigint, operations bigint")


def gate_outcome(spark, sf):
    """Publishing behind the gate: refused, with the reason, and nothing published."""
    table = _table(spark, "gate", M.GOLD_SCHEMA)
    suite = _suite()
    try:
        table.overwrite(I.gold(spark, sf), audit=lambda rows: Q.run_gate(rows, suite))
        problem = None
    except Q.QualityGateFailed as exc:
        problem = str(exc).partition(" (")[0]
    published = table.read().count() if table.exists() else 0
    return spark.createDataFrame(
        [(problem is not None, problem, published)], "refused boolean, reason string, rows_published int"
    )


def gate_failed_checks(spark, sf):
    """First 20 violating rows of every row-level, pair and uniqueness check, in one pass."""
    suite = _suite()
    asked = [n for n, c in enumerate(suite, 1) if c.columns and c.kind != "expect_column_values_to_be_of_type"]
    found = Q.failure_samples(_written_gold(spark, sf), suite, asked, ["machine_id", "reading_date"])
    return found.select("check_no", F.array_join("value", ",").alias("value"))


def gate_quarantine(spark, sf):
    rows = Q.quarantine(_written_gold(spark, sf), _suite())
    return rows.filter(F.size("violations") > 0).select(
        "machine_id", day("reading_date"), "anomaly_rate",
        F.array_join("violations", ";").alias("violations"),
    )


def label_checks(spark, sf):
    labelled = I.table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(
        I.table(spark, sf, "labels"), "doc_id", "left"
    )
    checks = [
        Q.not_null("doc_id"),
        Q.not_null("quality"),
        Q.in_set("quality", [1]),
        Q.in_set("toxic", [0, 1]),
        Q.between("n_chars", 20, 5000),
        Q.unique_together("doc_id"),
        Q.greater_than("quality", "toxic", or_equal=True),
    ]
    return Q.evaluate(labelled, checks)


def order_checks(spark, sf):
    checks = [
        Q.not_null("o_orderkey"),
        Q.in_set("o_orderstatus", ["F", "O"]),
        Q.between("o_totalprice", 1000, 450_000),
        Q.of_type("o_orderkey", "int64"),
        Q.unique_together("o_orderkey"),
    ]
    return Q.evaluate(I.table(spark, sf, "orders"), checks)


def compound_dups(spark, sf):
    return U.duplicate_keys(I.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def lineitem_checks(spark, sf):
    checks = [
        Q.unique_together("l_orderkey", "l_linenumber"),
        Q.greater_than("l_extendedprice", "l_quantity"),
        Q.between("l_discount", 0.0, 0.05),
    ]
    return Q.evaluate(I.table(spark, sf, "lineitem"), checks)


# --- corpus and retrieval -----------------------------------------------------------------


def kpi_documents(spark, sf):
    return D.kpi_documents(I.gold(spark, sf)).select("id", "source", "text")


def corpus_union(spark, sf):
    both = D.union_corpora(I.corpus(spark, sf), D.kpi_documents(I.gold(spark, sf)))
    return both.select("id", "source", "text", "ord_key")


def chunks(spark, sf):
    return I.chunks(spark, sf).select("id", "doc_id", "source", "pos", "text")


def chunks_of_three(spark, sf):
    return D.chunk(I.corpus(spark, sf), 3).select("id", "doc_id", "source", "pos", "text")


def chunk_counts(spark, sf):
    return D.chunk_counts(I.chunks(spark, sf))


def term_stats(spark, sf):
    terms = I.text_index(spark, sf).terms()
    return terms.select("term", "df", F.round("idf", 6).alias("idf"))


def postings(spark, sf):
    """The stored postings, joined to the ids of their chunks."""
    return I.text_index(spark, sf).postings()


def bm25_topk(spark, sf):
    found = B.bm25_search(I.text_index(spark, sf), I.questions(spark, sf))
    return B.bm25_hits(found)


def bm25_work(spark, sf):
    """Whether a search reads fewer blocks than are stored, and scores fewer postings than its terms have."""
    work = B.search_work(I.text_index(spark, sf), I.questions(spark, sf))
    return work.select(
        (F.col("read_blocks") < 0.5 * F.col("stored_blocks")).alias("fewer_blocks"),
        (F.col("scored") < 0.9 * F.col("of_terms")).alias("fewer_postings"),
    )


def index_after_changes(spark, sf):
    """BM25 on an index that a change batch brought up to date: toxic documents are taken out, good
    ones get another sentence, and the questions come in as documents of their own."""
    docs, labels = I.table(spark, sf, "documents"), I.table(spark, sf, "labels")
    index = B.TextIndex.build(I.chunks(spark, sf), _folder(spark, "changing"))
    removed = labels.filter("toxic = 1").select(F.col("doc_id").cast("string").alias("doc_id"))
    good = docs.join(labels.filter("quality = 1 AND coalesce(toxic, 0) <> 1").select("doc_id").distinct(), "doc_id", "left_semi")
    longer = good.select("doc_id", F.concat("text", F.lit(" Checked twice.")).alias("text"), "source")
    number = (F.col("item_id") + 1_000_000_000).cast("bigint").alias("doc_id")
    new = I.table(spark, sf, "benchmark").select(number, "text", F.lit("benchmark").alias("source"))
    changed = D.chunk(D.documents(longer.unionByName(new), "doc_id"))
    return B.bm25_hits(B.bm25_search(index.update(changed, removed), I.questions(spark, sf)))


def conversation_topk(spark, sf):
    """Every turn as a query, against all chunks."""
    return B.bm25_hits(B.bm25_search(I.text_index(spark, sf), I.turns(spark, sf)))


def _bounded(spark, sf) -> tuple[DataFrame, object]:
    """The vectors stored with their bounds, and the pivots."""
    rows = I.vectors(spark, sf)
    pivots = V.fit_pivots(rows, pivots=48)
    return materialise(V.with_bounds(rows, pivots), "bounded"), pivots


def dense_topk(spark, sf):
    stored, pivots = _bounded(spark, sf)
    return V.dense_hits(V.bounded_search(stored, pivots, I.vector_queries(spark, sf)))


def dense_work(spark, sf):
    """Whether the bounds save distances."""
    stored, pivots = _bounded(spark, sf)
    work = V.bounded_work(stored, pivots, I.vector_queries(spark, sf))
    return work.select("pairs", (F.col("measured") < 0.8 * F.col("pairs")).alias("fewer_distances"))


def _dense_text(spark, sf) -> DataFrame:
    embedded = V.hashing_embedder(text="query")(I.questions(spark, sf))
    return V.dense_search(I.embedded_chunks(I.text_index(spark, sf)), embedded.select("query_id", "embedding"))


def dense_text_topk(spark, sf):
    return V.dense_hits(_dense_text(spark, sf))


def dense_ann_recall(spark, sf):
    """Recall of the search by coded clusters, and the exact distances it measures."""
    rows, asked = I.vectors(spark, sf), I.vector_queries(spark, sf)
    model = V.fit_clusters(rows, clusters=16)
    coded, levels = V.with_codes(V.assign_clusters(rows, model), model)
    stored = V.write_clusters(coded, _folder(spark, "clusters"))
    near = V.coded_search(stored, model, levels, asked, probes=13, rescored=64)
    found = V.recall(V.dense_search(rows, asked), near)
    sizes = rows.agg(F.count(F.lit(1)).alias("n"))  # every query measures 64 distances instead of n
    return found.join(F.broadcast(sizes)).select(  # two frames of one row
        "exact_hits",
        (F.col("recall") >= 0.9).alias("recall_reached"),
        (F.lit(64) <= F.col("n") / 3).alias("fewer_distances"),
    )


def _stages(spark, sf) -> tuple[dict[str, DataFrame], X.PairScorer]:
    index = I.text_index(spark, sf)
    asked = I.questions(spark, sf)
    scorer = X.idf_overlap(asked, index.terms())
    dense, keyword = V.dense_hits(_dense_text(spark, sf)), B.bm25_hits(B.bm25_search(index, asked))
    return X.funnel(dense, keyword, asked, index.chunks(), scorer), scorer


def rrf_fused(spark, sf):
    asked = I.questions(spark, sf)
    fused = X.reciprocal_rank_fusion(
        V.dense_hits(_dense_text(spark, sf)), B.bm25_hits(B.bm25_search(I.text_index(spark, sf), asked))
    )
    return fused.withColumn("retrieved_by", F.array_join("retrieved_by", ","))


def funnel(spark, sf):
    return X.summarise_funnel(_stages(spark, sf)[0], I.text_index(spark, sf).chunks())


def rerank_topk(spark, sf):
    index = I.text_index(spark, sf)
    asked = I.questions(spark, sf)
    hits = materialise(B.bm25_hits(B.bm25_search(index, asked)), "keyword")
    pairs = X.with_chunk(hits, index.chunks(), "text").join(asked, "query_id")
    scorer = X.idf_overlap(asked, index.terms())
    best = X.rerank(pairs.withColumn("cand_id", F.col("chunk_id")), scorer, 4)
    return best.select("query_id", "rank", "chunk_id", F.round("score", 4).alias("score"))


def _answers(spark, sf) -> tuple[DataFrame, DataFrame]:
    stages, scorer = _stages(spark, sf)
    reranked = stages["reranked"]
    return A.extractive_answers(reranked, I.questions(spark, sf), scorer), reranked


def context_block(spark, sf):
    reranked = _stages(spark, sf)[0]["reranked"]
    blocks = A.context(reranked)
    return blocks.select(
        "query_id", "context_block", A.prompt(F.col("query"), F.col("context_block")).alias("prompt")
    )


def answers(spark, sf):
    found, _ = _answers(spark, sf)
    return found.select(
        "query_id",
        "backend",
        "answer",
        F.array_join("citations.chunk_id", ",").alias("cited"),
        F.array_join("context_chunk_ids", ",").alias("retrieved"),
        "grounded",
    )


def citation_audit(spark, sf):
    return A.citation_audit(*_answers(spark, sf))


def forged_citations(spark, sf):
    """The audit of answers whose first citation names a chunk that was not retrieved."""
    found, reranked = _answers(spark, sf)
    forged = F.transform(
        "citations",
        lambda c, i: F.when(i == 0, c.withField("chunk_id", F.lit("forged#c00"))).otherwise(c),
    )
    return A.citation_audit(found.withColumn("citations", forged), reranked)


# --- run log ------------------------------------------------------------------------------


def run_status(spark, sf):
    return presentable(R.run_status(I.run_events(spark, sf)))


def logged_run_status(spark, sf):
    """Runs by status, from events written and read as JSON lines."""
    folder = f"{checkpoint_dir(spark)}/thermolake/{spark.sparkContext.applicationId}/events-{uuid.uuid4().hex}"
    write_json_lines(I.run_events(spark, sf), folder)
    runs = R.run_status(R.read_events(spark, folder))
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"), F.sum("duration_ms").alias("total_ms"))


def run_errors(spark, sf):
    return R.run_errors(I.run_events(spark, sf))


def event_conformance(spark, sf):
    return R.conformance(I.run_events(spark, sf))


def events_pivot(spark, sf):
    return R.events_per_job(I.run_events(spark, sf))


ALL: list[Query] = [
    contract_accepted, contract_rejected, dead_letters, contract_error_counts,
    contract_routing_counts, bronze_rows, bronze_appended, silver_latest, silver_status, silver_touched, silver_incremental,
    silver_upsert, silver_rewritten, rejected_write, upsert_metrics, upsert_diff, distinct_keys, key_lookup, kpi_daily,
    distinct_keys_by_range, kpi_after_changes, unchanged_days, gold_overwritten, gate_incremental,
    kpi_reduction_check, schema_check, gate_report, gate_summary, gate_failed_checks,
    gate_quarantine, label_checks, order_checks, compound_dups, lineitem_checks, kpi_documents,
    corpus_union, chunks, chunks_of_three, chunk_counts, term_stats, postings, bm25_topk, bm25_work, index_after_changes,
    conversation_topk, dense_topk, dense_work, dense_text_topk, dense_ann_recall, rrf_fused, funnel,
    rerank_topk, context_block, answers, citation_audit, forged_citations, gate_outcome, run_status,
    logged_run_status, run_errors,
    event_conformance, events_pivot,
]


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(_prepared(spark), sf_dir)


def _prepared(spark: SparkSession) -> SparkSession:
    checkpoint_dir(configure(spark))
    return spark


def registered() -> dict[str, Query]:
    return {q.__name__: _configured(q) for q in ALL}
