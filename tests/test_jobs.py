"""The whole way: topic, Bronze, Silver, Gold behind the gate, answers."""

import json

import pytest
from pyspark.sql import functions as F

from tests.fixtures import overheat_readings, readings, violations
from tests.test_lakehouse import accepted, keyed
from tests.test_retrieval import TEXTS, corpus
from tests.test_streaming import deliver
from thermolake.operators import answers as A
from thermolake.operators import medallion as M
from thermolake.operators.quality import QualityGateFailed, quarantine, unique_together
from thermolake.plans import jobs
from thermolake.sources.files import write_json_lines
from thermolake.streaming import ingest as S


def test_from_topic_to_answers(spark, tmp_path):
    topic, out, check = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/check"
    silver = keyed(spark, tmp_path, "silver", M.SILVER_SCHEMA, partition_by="reading_date")
    gold = keyed(spark, tmp_path, "gold", M.GOLD_SCHEMA)

    deliver(topic, "1.json", [json.dumps(r) for r in readings() + violations()])
    assert S.ingest(S.file_topic(spark, str(topic)), out, check, "readings") == {"accepted": 12, "rejected": 4}
    jobs.refresh_silver(silver, S.read_bronze(spark, out))
    assert jobs.refresh_gold(silver.read(), gold, evidence=f"{tmp_path}/evidence")["rows"] == 3

    # The same readings again, overheated: Silver changes in place, the gate stops Gold.
    deliver(topic, "2.json", [json.dumps(r) for r in overheat_readings()])
    S.ingest(S.file_topic(spark, str(topic)), out, check, "readings")
    bronze = S.read_bronze(spark, out)
    merged = jobs.refresh_silver(silver, bronze, bronze.filter(F.col("ingest_batch") == 1))
    assert (merged["rows"], merged["rows_updated"], merged["rows_inserted"]) == (12, 12, 0)
    published = gold.read().orderBy("machine_id").collect()
    with pytest.raises(QualityGateFailed):
        jobs.refresh_gold(silver.read(), gold, evidence=f"{tmp_path}/evidence")
    assert gold.read().orderBy("machine_id").collect() == published
    assert spark.read.json(f"{tmp_path}/evidence").first().success is False

    static = corpus(spark, TEXTS)
    nowhere = keyed(spark, tmp_path, "nowhere", M.GOLD_SCHEMA)
    assert jobs.build_corpus(static, nowhere).count() == len(TEXTS)
    docs = jobs.build_corpus(static, gold)
    assert docs.count() == len(TEXTS) + 3
    asked = spark.createDataFrame(
        [(1, "What was the anomaly rate of machine CNC_MILL_01"), (2, "Where do malformed records go")],
        "query_id bigint, query string",
    )
    answers, stages = jobs.answer_questions(docs, asked, f"{tmp_path}/index", f"{tmp_path}/answers")
    found = {r.query_id: r for r in answers.collect()}
    assert "CNC_MILL_01" in found[1].answer and "[Source 1]" in found[2].answer
    assert all(r.grounded for r in found.values())
    assert spark.read.json(f"{tmp_path}/answers/stages").count() == 2 * (8 + 8 + 8 + 4)
    with pytest.raises(A.UngroundedAnswer):
        jobs.answer_questions(docs.limit(0), asked, f"{tmp_path}/empty")


def test_bronze_from_accepted_json_lines(spark, tmp_path):
    out = f"{tmp_path}/out"
    with pytest.raises(FileNotFoundError):
        jobs.append_bronze(spark, f"{tmp_path}/none", out, 0)
    write_json_lines(accepted(spark, readings()), f"{tmp_path}/a")
    assert jobs.append_bronze(spark, f"{tmp_path}/a", out, 0) == 12
    assert jobs.append_bronze(spark, f"{tmp_path}/a", out, 1) == 12
    assert jobs.append_bronze(spark, f"{tmp_path}/a", out, 1) == 12
    assert S.read_bronze(spark, out).count() == 24


def test_a_hot_machine_and_a_hot_reading(spark):
    """A third of the rows share a key; results are whole and exact."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    rows = spark.range(n).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("r"), "id")).alias("reading_id"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("M"), F.col("id") % 50)).alias("machine_id"),
        (F.col("id") % 1000 / 10).alias("temperature_c"),
        F.lit("2024-03-01 08:00:00").cast("timestamp").alias("recorded_at"),
        (F.col("id") % 1000 / 10 > 85).alias("is_anomaly"),
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        F.lit("2024-03-01 09:00:00").cast("timestamp").alias("ingested_at"),
    )
    silver = M.clean(rows)
    assert silver.count() == n - n // 3 + 1
    assert M.lookup(silver, "hot").first().temperature_c == (n - 3) % 1000 / 10
    every = rows.withColumn("reading_date", F.to_date("recorded_at"))
    kpi = M.lookup(M.daily_kpis(every), "HOT", "machine_id").first()
    values = [i % 1000 for i in range(0, n, 3)]
    assert kpi.readings == len(values) and kpi.anomaly_count == sum(v > 850 for v in values)
    assert kpi.avg_temperature_c == (2 * sum(values) * 10 + len(values)) // (2 * len(values)) / 100
    marked = quarantine(rows, [unique_together("machine_id", "reading_id")])
    assert marked.filter(F.size("violations") > 0).count() == n // 3
