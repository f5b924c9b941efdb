"""Streaming ingestion from a file topic."""

import json

import pytest

from tests.fixtures import overheat_readings, readings, violations
from thermolake.operators import medallion as M
from thermolake.sources import kafka
from thermolake.streaming import ingest as S


def deliver(path, name, payloads, first_offset=0):
    path.mkdir(exist_ok=True)
    lines = [
        json.dumps({"key": "k", "value": p, "topic": "readings", "partition": 0, "offset": first_offset + i})
        for i, p in enumerate(payloads)
    ]
    (path / name).write_text("\n".join(lines))


def test_restart_reads_only_new_input_and_equals_one_batch(spark, tmp_path):
    topic, out, check = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/check"
    good, bad = [json.dumps(r) for r in readings()], [json.dumps(r) for r in violations()]
    deliver(topic, "1.json", good[:6] + bad)
    stream = lambda: S.file_topic(spark, str(topic))
    assert S.ingest(stream(), out, check, "readings") == {"accepted": 6, "rejected": 4}
    with pytest.raises(S.EmptyIngest):  # nothing new
        S.ingest(stream(), out, check, "readings")
    deliver(topic, "2.json", good[6:] + ["{bad"], 10)
    assert S.ingest(stream(), out, check, "readings") == {"accepted": 6, "rejected": 1}
    assert S.ingest_totals(spark, out) == {"accepted": 12, "rejected": 5}
    bronze = S.read_bronze(spark, out)
    assert bronze.count() == 12 and bronze.select("ingest_batch").distinct().count() == 2
    letters = spark.read.json(f"{out}/dead_letters")
    assert sorted(r.rejection_reason for r in letters.collect()) == ["malformed_json"] + ["schema_validation_failed"] * 4

    whole = f"{tmp_path}/whole"
    S.ingest(stream(), whole, f"{tmp_path}/check2", "readings")
    columns = M.ACCEPTED_SCHEMA.names
    once = S.read_bronze(spark, whole).select(columns)
    assert bronze.select(columns).exceptAll(once).isEmpty() and once.count() == 12
    assert M.daily_kpis(M.clean(bronze)).count() == 3


def test_a_repeated_batch_replaces_its_first_attempt(spark, tmp_path):
    """The sink fails after Bronze was written; the batch runs again under the same id."""
    topic, out, check = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/check"
    deliver(topic, "1.json", [json.dumps(r) for r in overheat_readings() + violations()])
    calls = []

    def flaky(letters, batch_id):
        calls.append((batch_id, letters.count()))
        if len(calls) == 1:
            raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        S.ingest(S.file_topic(spark, str(topic)), out, check, "readings", dead_letter_sink=flaky)
    totals = S.ingest(S.file_topic(spark, str(topic)), out, check, "readings", dead_letter_sink=flaky)
    assert totals == {"accepted": 12, "rejected": 4} and calls == [(0, 4), (0, 4)]
    assert S.read_bronze(spark, out).count() == 12


def test_nothing_accepted_is_refused(spark, tmp_path):
    deliver(tmp_path / "topic", "1.json", ["{bad"])
    with pytest.raises(S.EmptyIngest):
        S.ingest(S.file_topic(spark, str(tmp_path / "topic")), f"{tmp_path}/o", f"{tmp_path}/c", "readings")
    assert spark.read.json(f"{tmp_path}/o/dead_letters").count() == 1


def test_a_later_drain_with_only_rejects_is_refused(spark, tmp_path):
    topic, out, check = tmp_path / "topic", f"{tmp_path}/o", f"{tmp_path}/c"
    deliver(topic, "1.json", [json.dumps(r) for r in readings()])
    assert S.ingest(S.file_topic(spark, str(topic)), out, check, "readings")["accepted"] == 12
    deliver(topic, "2.json", ["{bad", json.dumps(violations()[0])], 20)
    with pytest.raises(S.EmptyIngest):
        S.ingest(S.file_topic(spark, str(topic)), out, check, "readings")
    assert S.ingest_totals(spark, out) == {"accepted": 12, "rejected": 2}
    assert S.read_bronze(spark, out).count() == 12


def test_topic_messages_and_options(spark):
    rows = spark.createDataFrame([("M1", 70.5)], "machine_id string, temperature_c double")
    assert kafka.keyed_messages(rows).first() == ("M1", '{"machine_id":"M1","temperature_c":70.5}')
    assert kafka.publish(rows, "broker:9092", "t", fmt="noop") == 1
    options = kafka.read_options("broker:9092", "t", max_offsets_per_trigger=5)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5"
    assert kafka.write_options("b", "t")["kafka.acks"] == "all"
