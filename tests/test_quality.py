"""Quality suite and gate (FIXTURES.md A5)."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from thermolake.operators import quality as Q
from thermolake.operators.medallion import GOLD_SCHEMA

DAY = date(2024, 3, 1)
HEALTHY = [
    ("CNC_MILL_01", DAY, 4, 1, 75.0, 96.5, 66.0, 0.25, 30.5),
    ("ROBOTIC_ARM_02", DAY, 4, 1, 76.0, 97.5, 67.0, 0.25, 30.5),
]
OVERHEAT = [("CNC_MILL_01", DAY, 4, 3, 90.0, 99.5, 67.0, 0.75, 32.5)]


def gold(spark, rows):
    return spark.createDataFrame(rows, GOLD_SCHEMA)


def failed(spark, rows, checks):
    report = Q.evaluate(rows, checks).collect()
    return {(r.expectation, r.column): r.unexpected_count for r in report if not r.success}


def test_healthy_gold_passes_all_fourteen(spark, tmp_path):
    summary = Q.run_gate(gold(spark, HEALTHY), Q.gold_suite(), f"{tmp_path}/e")
    assert summary["expectations_passed"] == 14 and summary["success_percent"] == 100.0
    assert summary["observed_max_anomaly_rate"] == 0.25 and summary["gold_rows"] == 2


def test_overheated_gold_fails_one_and_leaves_evidence(spark, tmp_path):
    with pytest.raises(Q.QualityGateFailed, match="1 of 14"):
        Q.run_gate(gold(spark, OVERHEAT), Q.gold_suite(), f"{tmp_path}/e")
    text = "".join(p.read_text() for p in Path(f"{tmp_path}/e").glob("part-*"))
    evidence = json.loads(text)
    assert evidence["success"] is False and evidence["success_percent"] == 92.86
    (failure,) = evidence["failed_expectations"]
    assert failure["column"] == "anomaly_rate" and failure["unexpected_count"] == 1
    assert failure["partial_unexpected_list"] == ["0.75"]
    rows, suite = gold(spark, OVERHEAT), Q.gold_suite()
    row = Q.summarise(Q.evaluate(rows, suite), rows, suite).first()
    assert tuple(row) == (False, 14, 13, 1, 92.86, 1, 0.6, 0.75)


def test_bounds_on_volume_belong_to_the_caller(spark):
    rows = gold(spark, HEALTHY)
    assert failed(spark, rows, Q.gold_suite(max_rows=1, max_readings=3)) == {
        ("expect_table_row_count_to_be_between", None): None,
        ("expect_column_values_to_be_between", "readings"): 2,
    }
    many = rows.withColumn("readings", F.lit(10**12)).withColumn("anomaly_count", F.lit(10**11))
    assert failed(spark, many, Q.gold_suite()) == {}


def test_the_ceiling_is_inclusive(spark):
    row = [(*OVERHEAT[0][:7], 0.6, 32.5)]
    assert failed(spark, gold(spark, row), Q.gold_suite()) == {}


def test_missing_values(spark):
    rows = gold(spark, HEALTHY).withColumn("anomaly_rate", F.lit(None).cast("double"))
    assert failed(spark, rows, Q.gold_suite()) == {("expect_column_values_to_not_be_null", "anomaly_rate"): 2}
    rows = gold(spark, HEALTHY).withColumn("anomaly_rate", F.lit(float("nan")))
    assert failed(spark, rows, Q.gold_suite()) == {("expect_column_values_to_not_be_null", "anomaly_rate"): 2}


def test_pairs_and_compound_keys_with_nulls(spark):
    rows = spark.createDataFrame(
        [(1, 2), (None, None), (None, None), (3, None), (2, 2), (2, 2), (3, None)], "a int, b int"
    )
    got = failed(spark, rows, [Q.greater_than("a", "b", or_equal=True), Q.unique_together("a", "b")])
    # One pair is below, two have one side only; (2, 2) and (3, null) come twice.
    assert got == {
        ("expect_column_pair_values_A_to_be_greater_than_B", "a,b"): 3,
        ("expect_compound_columns_to_be_unique", "a,b"): 4,
    }


def test_structure_checks(spark):
    rows = gold(spark, HEALTHY)
    assert failed(spark, rows.drop("temp_spread_c"), [Q.columns_match(*GOLD_SCHEMA.names)])
    assert not failed(spark, rows.select(*reversed(rows.columns)), [Q.columns_match(*GOLD_SCHEMA.names)])
    assert failed(spark, rows.withColumn("readings", F.lit(1)), [Q.of_type("readings", "int64")])
    assert failed(spark, rows.limit(0), [Q.row_count_between(1, 10)])
    with pytest.raises(ValueError):
        Q.evaluate(rows, [Q.Check("expect_magic")])


def test_samples_and_quarantine(spark):
    rows = gold(spark, HEALTHY + OVERHEAT)
    out = {(r.machine_id, r.anomaly_rate): r.violations for r in Q.quarantine(rows, Q.gold_suite()).collect()}
    unique = "expect_compound_columns_to_be_unique(machine_id,reading_date)"
    assert out[("ROBOTIC_ARM_02", 0.25)] == []
    assert out[("CNC_MILL_01", 0.25)] == [unique]
    assert out[("CNC_MILL_01", 0.75)] == [unique, "expect_column_values_to_be_between(anomaly_rate)"]
    many = rows.crossJoin(spark.range(30)).drop("id")
    check = Q.between("anomaly_rate", 0.0, 0.6)
    assert Q.failure_sample(many, check, ["machine_id"]).count() == 20
    repeated = Q.failure_sample(many, Q.unique_together("machine_id", "reading_date"), [])
    assert [r.machine_id for r in repeated.collect()] == ["CNC_MILL_01", "ROBOTIC_ARM_02"]
    pair = Q.greater_than("min_temperature_c", "max_temperature_c")
    assert Q.failure_sample(rows, pair, ["machine_id", "max_temperature_c"]).first().asDict() == {
        "min_temperature_c": 66.0, "max_temperature_c": 96.5,
    }


def test_value_checks_share_one_scan(spark, tmp_path):
    gold(spark, HEALTHY).write.parquet(f"{tmp_path}/g")
    checks = [c for c in Q.gold_suite() if c.kind != "expect_compound_columns_to_be_unique"]
    plan = Q.evaluate(spark.read.parquet(f"{tmp_path}/g"), checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
