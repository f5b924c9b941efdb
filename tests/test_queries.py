"""Every registered query against its SQL, and the driver contract."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from thermolake.operators.dense import hashing_embedder
from thermolake.plans import inputs
from tools.check_oracles import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name)[0] is None


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_probed_search_finds_most_neighbours(spark, sf_dir):
    row = entry.queries()["dense_ann_recall"](spark, sf_dir).first()
    assert row.exact_hits == 4000 and row.recall_reached and row.fewer_distances


def test_every_vector_is_a_query_against_all_rows(spark, tmp_path):
    vectors = [(i, [float(i % 7), 1.0]) for i in range(120)] + [(None, [0.0, 1.0])]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    asked = [r.query_id for r in inputs.vector_queries(spark, str(tmp_path)).collect()]
    assert sorted(asked, key=lambda i: (i is None, i)) == [*range(120), None]
    assert inputs.vectors(spark, str(tmp_path)).count() == 121


def test_work_counts_every_pair_of_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=4).tolist()) for i in range(1, 121)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert entry.queries()["dense_work"](spark, str(tmp_path)).first().pairs == 120 * 120


def test_every_turn_is_a_query(spark, tmp_path):
    turns = [(i, t, f"turn {t} of {i}") for i in range(101) for t in range(2)]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    asked = {r.query_id: r.query for r in inputs.turns(spark, str(tmp_path)).collect()}
    assert asked == {f"{i}-{t}": text for i, t, text in turns}


def test_the_index_of_the_queries_stores_no_vectors(spark, sf_dir):
    """Vectors come from the tokens when a search reads the chunks, the same as those of the texts."""
    index = inputs.text_index(spark, sf_dir)
    assert "embedding" not in index.chunks().columns
    made = inputs.embedded_chunks(index).select("id", "embedding").limit(50)
    of_text = hashing_embedder()(index.chunks().drop("tokens")).select("id", F.col("embedding").alias("of_text"))
    rows = made.join(of_text, "id").collect()
    assert len(rows) == 50 and all(r.embedding == r.of_text for r in rows)


def test_events_of_one_row_group_are_dealt_out(spark, tmp_path, monkeypatch):
    """A file of many splits whose rows are all in one row group gives every task a share of the rows."""
    rows = spark.range(20_000).selectExpr(
        "id as event_id", "timestamp_seconds(id) as ts", "id % 50 as user_id", "'view' as event_type", "id / 7 as value", "concat('{\"k\": ', id, '}') as props"
    )
    pq.write_table(rows.toArrow(), f"{tmp_path}/events.parquet", row_group_size=20_000)
    monkeypatch.setattr(inputs, "EVENTS_PER_TASK", 1_000, raising=False)
    settings = {"spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k"}
    usual = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        topic = inputs.topic(spark, str(tmp_path))
        of_task = [r["count"] for r in topic.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)
    assert sum(of_task) == 20_000 and max(of_task) <= 1_500
