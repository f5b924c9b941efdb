"""State that adds up, against the same tables computed from all rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from thermolake.operators import incremental as N
from thermolake.operators import medallion as M
from thermolake.operators import quality as Q
from thermolake.operators import upsert as U
from thermolake.plans import jobs
from thermolake.session import checkpoint_dir
from thermolake.sources.tables import KeyedTable, write_for_lookup

START = datetime(2024, 3, 1)


def deliveries(spark, rnd, n, first_offset=0):
    """Bronze rows of 40 keys, with late, repeated and corrected ones."""
    rows = []
    for _ in range(n):
        key, offset = rnd.randrange(40), first_offset + rnd.randrange(30)
        stamp = START + timedelta(hours=7 * key)
        came = stamp + timedelta(hours=rnd.randrange(5))
        rows.append((f"r{key}", f" m{key % 3}", float(rnd.randrange(600, 1000)) / 10, stamp, rnd.random() < 0.3, rnd.randrange(2), offset, came))
    return spark.createDataFrame(rows, M.BRONZE_SCHEMA)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_versions_replace_a_scan_of_bronze(spark, tmp_path):
    checkpoint_dir(spark)
    rnd = random.Random(3)
    silver = KeyedTable(spark, "silver_by_versions", M.SILVER_SCHEMA, "reading_date", f"{tmp_path}/silver")
    known = KeyedTable(spark, "versions_of_silver", jobs.VERSION_SCHEMA, None, f"{tmp_path}/versions")
    everything = None
    for step in range(3):
        batch = deliveries(spark, rnd, 60, 10 - 5 * step)
        everything = batch if everything is None else everything.unionByName(batch)
        jobs.refresh_silver_by_versions(silver, known, batch)
        again = jobs.refresh_silver_by_versions(silver, known, batch)
        assert again["rows_updated"] == again["rows_inserted"] == 0  # the same batch has nothing newer
        assert rows_of(silver.read()) == rows_of(M.clean(everything))
        assert rows_of(known.read()) == rows_of(N.versions(everything))


def silver_rows(spark, values):
    """(key, machine, day, cents) as Silver."""
    rows = [(str(k), m, v / 100, START, (START + timedelta(days=d)).date(), "NORMAL", v > 8500, START) for k, m, d, v in values]
    return spark.createDataFrame(rows, M.SILVER_SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_partials_after_changes_equal_a_new_aggregation(spark, seed):
    rnd = random.Random(seed)
    pick = lambda k: (k, rnd.choice("ab"), rnd.randrange(4), rnd.choice([100, 200, 200, 9000, 9100]))
    state = {k: pick(k) for k in range(40)}
    changed = {k: pick(k) for k in rnd.sample(range(60), 25)}
    changed[100] = (100, "new", 9, 5)
    moved = [k for k, v in state.items() if v[1:3] == ("a", 0)]
    changed |= {k: (k, "b", 1, 300) for k in moved}  # a group loses all of its rows
    before, source = silver_rows(spark, state.values()), silver_rows(spark, changed.values())
    after = U.upsert(before, source, "reading_id")
    partials = M.kpi_partials(before)
    removed = before.join(source.select("reading_id"), "reading_id", "left_semi")
    new, gone = N.partials_after(partials, removed, source, after)
    assert rows_of(N.replace_groups(partials, new, gone, N.GROUP)) == rows_of(M.kpi_partials(after))
    touched = {v[1:3] for v in changed.values()} | {state[k][1:3] for k in changed if k in state}
    assert new.count() + gone.count() == len(touched)
    assert rows_of(M.kpis(new)) == rows_of(M.daily_kpis(after).join(new.select(*N.GROUP), N.GROUP, "left_semi"))


def test_fingerprints_see_any_difference_but_the_order(spark):
    base = [(i, "m", i % 4, 100 + i) for i in range(40)]
    one = silver_rows(spark, base)
    shuffled = silver_rows(spark, reversed(base)).repartition(5)
    mark = lambda f: N.fingerprints(f, "reading_date")
    assert N.differing(mark(one), mark(shuffled), "reading_date").isEmpty()
    for other in (base[1:], base + base[:1], [*base[:-1], (39, "m", 3, 999)], [*base[:-1], (39, "m", 2, 139)]):
        days = {r[0].day - 1 for r in N.differing(mark(one), mark(silver_rows(spark, other)), "reading_date").collect()}
        have, want = sorted(base), sorted(other)
        assert days == {d for d in range(4) if [r for r in have if r[2] == d] != [r for r in want if r[2] == d]}
    with pytest.raises(U.UpsertNotProven, match="source rows are missing"):
        U.prove_upsert(one, silver_rows(spark, [(1, "m", 1, 5)]), one, "reading_id")


def test_check_states_add_up(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None]), rnd.randrange(4), rnd.choice([1, 2, None, 50])) for _ in range(80)]
    frame = spark.createDataFrame(rows, "name string, day int, value int")
    checks = [
        Q.not_null("name"), Q.in_set("name", ["a"]), Q.between("value", 0, 10), Q.unique_together("name", "day"),
        Q.of_type("value", "int64"), Q.row_count_between(1, 50), Q.columns_match("name", "day", "value"),
    ]
    states = N.check_states(frame, checks, "day")
    assert rows_of(N.report_of_states(states, frame, checks)) == rows_of(Q.evaluate(frame, checks))
    changed = frame.filter("day <> 2").unionByName(frame.filter("day = 2").limit(1))
    new = N.check_states(changed.filter("day = 2"), checks, "day")
    merged = N.replace_groups(states, new, new.limit(0), ["day"])
    assert rows_of(N.report_of_states(merged, changed, checks)) == rows_of(Q.evaluate(changed, checks))
    with pytest.raises(ValueError, match="no column of the unique key"):
        N.check_states(frame, [Q.unique_together("name")], "day")


def test_samples_of_all_checks_in_one_scan(spark, tmp_path):
    frame = spark.createDataFrame([(i, i % 7, None if i % 5 else i) for i in range(200)], "id int, a int, b int")
    frame.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    checks = [Q.not_null("b"), Q.between("a", 0, 3), Q.greater_than("id", "a"), Q.of_type("a", "int64")]
    found = Q.failure_samples(stored, checks, [1, 2, 3], ["id"], 20)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    for number in (1, 2, 3):
        mine = [r.value for r in found.filter(F.col("check_no") == number).orderBy("rank").collect()]
        want = Q.failure_sample(stored, checks[number - 1], ["id"], 20).collect()
        assert mine == [[None if v is None else str(v) for v in r] for r in want]


def test_sketches_merge(spark):
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 5000).alias("reading_id"), (F.col("id") % 8).alias("day"))
    sketches = N.key_sketches(rows, F.col("day"))
    for r in N.distinct_of(sketches, F.col("part") % 2).collect():
        exact = rows.filter(F.col("day") % 2 == r.part).select("reading_id").distinct().count()
        assert abs(r.distinct_keys - exact) < 0.05 * exact


def test_a_lookup_reads_one_row_group(spark, tmp_path):
    rows = spark.range(40_000).select(F.concat(F.lit("k"), F.col("id") * 7919 % 40_000).alias("reading_id"), F.col("id").alias("v"))
    stored = write_for_lookup(rows.repartition(6), "reading_id", f"{tmp_path}/l", files=5)
    files = stored.select(F.input_file_name()).distinct().count()
    found = M.lookup(stored, "k123")
    assert [r.reading_id for r in found.collect()] == ["k123"]
    plan = found._jdf.queryExecution().executedPlan()
    assert "EqualTo(reading_id,k123)" in plan.toString()
    read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert files > 1 and 0 < read < 40_000 / files * 2
    missing = M.lookup(stored, "k1235x")  # within the range of a file, in no Bloom filter
    assert missing.collect() == []
    assert missing._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value() == 0


def test_a_null_temperature_is_normal(spark):
    row = ("r", "m", None, START, False, 0, 1, START)
    nullable = "reading_id string, machine_id string, temperature_c double, recorded_at timestamp, is_anomaly boolean, kafka_partition int, kafka_offset bigint, ingested_at timestamp"
    assert M.clean(spark.createDataFrame([row], nullable)).first().status == "NORMAL"
