"""Bronze, Silver, Gold, upsert and snapshot tables (FIXTURES.md A1, A2, A4)."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings as hyp
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.fixtures import MACHINES, overheat_readings, readings
from thermolake.functions.numbers import divide_half_up, float_text
from thermolake.operators import medallion as M
from thermolake.operators import upsert as U
from thermolake.plans import jobs
from thermolake.session import checkpoint_dir
from thermolake.sources.files import BrokenInput, EmptyInput, read_accepted, write_json_lines
from thermolake.sources.tables import KeyedTable, SchemaMismatch, TableExists, TableMissing

NOON = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)


def accepted(spark, rows):
    data = [
        (
            r["reading_id"], r["machine_id"], r["temperature_c"],
            datetime.fromisoformat(r["recorded_at"]), r["temperature_c"] > 85.0, 0, i,
        )
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, M.ACCEPTED_SCHEMA)


def bronze(spark, rows, hours=0):
    return M.bronze(accepted(spark, rows), F.lit(NOON + timedelta(hours=hours)))


def keyed(spark, tmp_path, name, schema, **options):
    """A table of its own for each test."""
    return KeyedTable(spark, f"{name}_{tmp_path.name}", schema, path=f"{tmp_path}/{name}", **options)


@pytest.fixture(autouse=True, scope="module")
def shared_folder(spark):
    checkpoint_dir(spark)


@pytest.mark.parametrize(
    "rows, expected",
    [
        (readings(), [(1, 75.13, 99.5, 66.0, 0.25, 33.5), (1, 75.88, 99.5, 67.0, 0.25, 32.5), (1, 76.63, 99.5, 68.0, 0.25, 31.5)]),
        (overheat_readings(), [(3, 90.38, 99.5, 66.0, 0.75, 33.5), (3, 90.63, 99.5, 67.0, 0.75, 32.5), (3, 90.88, 99.5, 68.0, 0.75, 31.5)]),
    ],
)
def test_gold_of_the_fixture_batches(spark, rows, expected):
    silver = M.clean(bronze(spark, rows))
    assert silver.schema == M.SILVER_SCHEMA or silver.columns == M.SILVER_SCHEMA.names
    gold = {r.machine_id: r for r in M.daily_kpis(silver).collect()}
    for machine, want in zip(MACHINES, expected, strict=True):
        r = gold[machine]
        assert (r.readings, str(r.reading_date)) == (4, "2024-03-01")
        assert (r.anomaly_count, *r[4:]) == want
    assert M.daily_kpis(silver).columns == M.GOLD_SCHEMA.names


def test_both_anomaly_verdicts_are_kept(spark):
    row = {**readings()[0], "temperature_c": 85.004, "machine_id": " cnc_mill_01 "}
    r = M.clean(bronze(spark, [row])).first()
    assert (r.is_anomaly, r.status, r.temperature_c, r.machine_id) == (True, "NORMAL", 85.0, "CNC_MILL_01")


def test_latest_delivery_does_not_depend_on_row_order(spark):
    rnd = random.Random(3)
    rows = [
        (f"r{rnd.randrange(5)}", "M", float(i), NOON, False, 0, rnd.randrange(4), NOON + timedelta(minutes=rnd.randrange(3)))
        for i in range(200)
    ]
    want = {}
    for r in rows:
        key = (r[6], r[7], r[5], r[2])
        if r[0] not in want or key > want[r[0]][0]:
            want[r[0]] = (key, r[2])
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, M.BRONZE_SCHEMA).repartition(3 + seed)
        got = {r.reading_id: r.temperature_c for r in M.latest_per_key(df).collect()}
        assert got == {k: v[1] for k, v in want.items()}


def test_dedup_limits_hot_keys_before_the_shuffle(spark):
    plan = M.latest_per_key(bronze(spark, readings()))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_touched_keys_see_late_older_deliveries(spark):
    old, new = bronze(spark, readings()), bronze(spark, overheat_readings(), hours=1)
    late = old.limit(1)
    touched = M.clean_touched(old.unionByName(new), late).collect()
    assert len(touched) == 1 and touched[0].ingested_at.hour == 13


def test_upsert_updates_in_place_and_is_idempotent(spark, tmp_path):
    table = keyed(spark, tmp_path, "silver", M.SILVER_SCHEMA)
    with pytest.raises(TableMissing):
        table.read()
    first = M.clean(bronze(spark, readings()))
    assert table.upsert(first, "reading_id")["operation"] == "create"
    before = table.read().checkpoint()
    both = bronze(spark, readings()).unionByName(bronze(spark, overheat_readings(), hours=1))
    source = M.clean(both)
    result = table.upsert(source, "reading_id")
    assert result == {
        "version": 1, "operation": "merge", "rows": 12, "rows_before": 12,
        "rows_updated": 12, "rows_inserted": 0, "rows_rewritten": 12,
    }
    after = table.read()
    row = M.lookup(after, "CNC_MILL_01-01").collect()
    assert [(r.temperature_c, r.status) for r in row] == [(97.5, "ANOMALY")]
    assert U.prove_upsert(before, source, after, "reading_id")["rows_after"] == 12
    diff = {r.reading_id: r for r in U.snapshot_diff(before, after, "reading_id", ["temperature_c", "status"]).collect()}
    assert diff["CNC_MILL_01-01"].before_temperature_c == 67.0 and len(diff) == 6
    touched = U.change_diff(before, source, "reading_id", ["temperature_c", "status"]).collect()
    assert {r.reading_id: r for r in touched} == diff
    after = after.checkpoint()
    again = table.upsert(source, "reading_id")
    assert again["rows"] == 12 and table.read().exceptAll(after).isEmpty()
    assert [r.operation for r in table.history().collect()] == ["create", "merge", "merge"]
    assert table.last_operation()["version"] == 2


def test_upsert_with_new_and_without_any_rows(spark, tmp_path):
    table = keyed(spark, tmp_path, "silver", M.SILVER_SCHEMA)
    silver = M.clean(bronze(spark, readings()))
    table.create(silver.filter("machine_id = 'CNC_MILL_01'"))
    with pytest.raises(TableExists):
        table.create(silver)
    r = table.upsert(silver, "reading_id")
    assert (r["rows"], r["rows_updated"], r["rows_inserted"]) == (12, 4, 8)
    r = table.upsert(silver.filter("machine_id = 'none'"), "reading_id")
    assert (r["rows"], r["rows_updated"], r["rows_inserted"]) == (12, 0, 0)


def test_partitioned_upsert_rewrites_only_touched_days(spark, tmp_path):
    table = keyed(spark, tmp_path, "silver", M.SILVER_SCHEMA, partition_by="reading_date")
    silver = M.clean(bronze(spark, readings()))
    day = F.date_add(F.col("reading_date"), F.substring("reading_id", -1, 1).cast("int"))
    spread = silver.withColumn("reading_date", day).withColumn("recorded_at", day.cast("timestamp"))
    table.upsert(spread, "reading_id")
    days = lambda: [r[0] for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()]
    files = lambda: {(str(r[0]), r[1]) for r in spark.table(table.name).select("reading_date", F.input_file_name()).distinct().collect()}
    assert days() == [f"reading_date=2024-03-0{i}" for i in range(1, 5)]
    first = files()
    before = spark.createDataFrame(table.read().collect(), M.SILVER_SCHEMA)
    assert table.read().schema == M.SILVER_SCHEMA

    # All rows of the 2nd move to the 3rd, one row of the 3rd changes, one new row lands on the 9th.
    third = F.lit("2024-03-03").cast("date")
    moved = spread.filter("reading_date = '2024-03-02'").withColumn("reading_date", third)
    changed = spread.filter("reading_id = 'CNC_MILL_01-02'").withColumn("temperature_c", F.lit(1.0))
    new = spread.limit(1).withColumn("reading_id", F.lit("new")).withColumn("reading_date", F.lit("2024-03-09").cast("date"))
    source = moved.unionByName(changed).unionByName(new).checkpoint()
    seen = []
    result = table.upsert(source, "reading_id", audit=lambda rows: seen.append(rows.count()))
    assert result == {
        "version": 1, "operation": "merge", "rows": 13, "rows_before": 12, "rows_updated": 4,
        "rows_inserted": 1, "rows_rewritten": 7,
    }
    assert seen == [13]
    assert {d for d, _ in files() & first} == {"2024-03-01", "2024-03-04"}
    assert days() == [f"reading_date=2024-03-0{i}" for i in (1, 3, 4, 9)]
    after = table.read()
    U.prove_upsert(before, source, after, "reading_id")
    assert after.filter("reading_date = '2024-03-02'").isEmpty()
    want = U.upsert(before, source, "reading_id")
    assert after.exceptAll(want).isEmpty() and want.exceptAll(after).isEmpty()


def test_failed_proof_and_duplicate_source(spark, tmp_path):
    silver = M.clean(bronze(spark, readings()))
    with pytest.raises(U.AmbiguousSource):
        keyed(spark, tmp_path, "t", M.SILVER_SCHEMA).upsert(silver.unionByName(silver), "reading_id")
    with pytest.raises(U.UpsertNotProven):
        U.prove_upsert(silver, silver, silver.unionByName(silver), "reading_id")
    with pytest.raises(U.UpsertNotProven):
        U.prove_upsert(silver.limit(0), silver, silver.withColumn("temperature_c", F.lit(0.0)), "reading_id")


def test_wrong_schema_is_refused_and_changes_nothing(spark, tmp_path):
    table = keyed(spark, tmp_path, "silver", M.SILVER_SCHEMA)
    silver = M.clean(bronze(spark, readings()))
    table.create(silver)
    before, log = table.read().checkpoint(), table.history().collect()
    bad = silver.withColumn("temperature_c", F.lit("not-a-number"))
    for write in (table.overwrite, lambda s: table.upsert(s, "reading_id")):
        with pytest.raises(SchemaMismatch, match="temperature_c: string instead of double"):
            write(bad)
        with pytest.raises(SchemaMismatch, match="status"):
            write(silver.drop("status"))
    after = table.read()
    assert table.history().collect() == log and after.schema == before.schema
    assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty()


def test_catalog_tables_refuse_unsafe_casts(spark, tmp_path):
    silver = M.clean(bronze(spark, readings()))
    silver.write.option("path", f"{tmp_path}/t").saveAsTable("strict_silver")
    try:
        bad = silver.withColumn("temperature_c", F.lit("not-a-number"))
        with pytest.raises(PySparkException, match="INCOMPATIBLE_DATA_FOR_TABLE"):
            bad.write.insertInto("strict_silver")
        assert spark.table("strict_silver").count() == 12
    finally:
        spark.sql("DROP TABLE strict_silver")


def test_failed_audit_publishes_nothing(spark, tmp_path):
    table = keyed(spark, tmp_path, "gold", M.GOLD_SCHEMA)
    silver = M.clean(bronze(spark, readings()))
    gold = M.daily_kpis(silver)
    table.overwrite(gold, audit=lambda snapshot: M.require_reduction(silver, snapshot))
    one_each = silver.dropDuplicates(["machine_id"])
    with pytest.raises(M.NotAnAggregate):
        table.overwrite(gold, audit=lambda snapshot: M.require_reduction(one_each, snapshot))
    assert table.history().count() == 1 and table.read().count() == 3


def test_lookup_reaches_the_scan(spark, tmp_path):
    M.clean(bronze(spark, readings())).write.parquet(f"{tmp_path}/s")
    plan = M.lookup(spark.read.parquet(f"{tmp_path}/s"), "x")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(reading_id), EqualTo(reading_id,x)]" in plan


def test_accepted_json_lines(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_accepted(spark, f"{tmp_path}/none")
    rows = accepted(spark, readings())
    write_json_lines(rows, f"{tmp_path}/a")
    assert read_accepted(spark, f"{tmp_path}/a").exceptAll(rows).isEmpty()
    write_json_lines(rows.limit(0), f"{tmp_path}/b")
    with pytest.raises(EmptyInput):
        read_accepted(spark, f"{tmp_path}/b")


@pytest.mark.parametrize(
    "line", ["{broken", "{}", '{"reading_id": "r"}', "[1]", '{"reading_id": "r", "temperature_c": "hot"}'],
)
def test_broken_and_incomplete_records_are_refused(spark, tmp_path, line):
    write_json_lines(accepted(spark, readings()), f"{tmp_path}/a")
    (tmp_path / "a" / "more.json").write_text(line + "\n")
    with pytest.raises(BrokenInput):
        jobs.append_bronze(spark, f"{tmp_path}/a", f"{tmp_path}/out", 0)
    assert not (tmp_path / "out").exists()


def test_microseconds_survive_accepted_json(spark, tmp_path):
    rows = accepted(spark, [{**readings()[0], "recorded_at": "2024-03-01T08:00:00.123456+00:00"}])
    write_json_lines(rows, f"{tmp_path}/a")
    assert read_accepted(spark, f"{tmp_path}/a").collect() == rows.collect()


def test_nulls_in_non_null_columns_are_refused(spark, tmp_path):
    schema = T.StructType([T.StructField("reading_id", T.StringType(), False), *M.SILVER_SCHEMA.fields[1:]])
    table = keyed(spark, tmp_path, "t", schema)
    silver = M.clean(bronze(spark, readings()))
    table.create(silver)
    with pytest.raises(PySparkException, match="reading_id is null"):
        table.overwrite(silver.withColumn("reading_id", F.lit(None).cast("string")))
    assert table.history().count() == 1 and table.read().count() == 12


def test_merge_needs_a_catalog_with_row_level_changes(spark, tmp_path):
    silver = M.clean(bronze(spark, readings()))
    silver.write.option("path", f"{tmp_path}/t").saveAsTable("plain_silver")
    try:
        with pytest.raises(PySparkException, match="MERGE"):
            U.merge_into(spark, "plain_silver", silver, "reading_id")
    finally:
        spark.sql("DROP TABLE plain_silver")


def test_counts_of_keys(spark):
    b = bronze(spark, readings() + readings()[:3])
    assert tuple(M.distinct_keys(b).first()) == (15, 12)
    assert M.approx_distinct_keys(b).first()[0] == 12


@hyp(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False) | st.sampled_from([0.0, 1e-4, 1e7, 1e16, 0.0005, 123456789.125]), min_size=1, max_size=60))
def test_number_text_is_the_shortest_one(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(float_text(F.col("v"))).collect()]
    assert [float(g) for g in got] == values
    plain = [(g, repr(v)) for g, v in zip(got, values, strict=True) if v == 0 or 1e-4 <= abs(v) < 1e16]
    assert all(g == w for g, w in plain)


def test_half_up_division(spark):
    cases = [(5, 2, 3), (-5, 2, -3), (7, 3, 2), (-7, 3, -2), (0, 9, 0), (1, 2, 1)]
    df = spark.createDataFrame(cases, "a bigint, b bigint, q bigint")
    assert df.filter(divide_half_up(F.col("a"), F.col("b")) != F.col("q")).isEmpty()
