"""Contract rules: fixtures from FIXTURES.md A1, and a judge of every field by the public pydantic library."""

import json
from datetime import UTC, datetime, timedelta
from typing import Annotated, Any

import pytest
from pyspark.sql import functions as F

from tests.fixtures import overheat_readings, readings, violations
from thermolake.operators import contract as C

OK = {
    "reading_id": "r-1",
    "machine_id": "CNC_MILL_01",
    "temperature_c": 70.0,
    "recorded_at": "2024-03-01T08:00:00+00:00",
}


def topic(spark, payloads):
    rows = [
        (b"k", p if isinstance(p, (bytes, type(None))) else p.encode(), "readings", 0, i)
        for i, p in enumerate(payloads)
    ]
    return spark.createDataFrame(
        [(bytearray(k), None if v is None else bytearray(v), t, p, o) for k, v, t, p, o in rows],
        "key binary, value binary, topic string, partition int, offset long",
    )


def judge(spark, payloads):
    out = C.validate(topic(spark, payloads)).orderBy("offset").collect()
    return [(r.rejection_reason, [(e.field, e.error) for e in r.errors]) for r in out]


def test_healthy_batch_is_12_accepted_4_rejected(spark):
    df = topic(spark, [json.dumps(r) for r in readings() + violations()])
    v = C.validate(df)
    assert C.routing_counts(v).first() == (12, 4)
    reasons = {r.rejection_reason for r in C.dead_letters(v, "readings").collect()}
    assert reasons == {C.INVALID}
    fields = {r.field: r.errors for r in C.error_counts(v).collect()}
    assert fields == {"machine_id": 1, "temperature_c": 2, "recorded_at": 1}


def test_anomaly_rates_of_both_scenarios(spark):
    for rows, expected in ((readings(), 3), (overheat_readings(), 9)):
        a = C.accepted(C.validate(topic(spark, [json.dumps(r) for r in rows])))
        assert a.filter("is_anomaly").count() == expected


@pytest.mark.parametrize(
    "payload",
    [
        "{bad", "", "[1]", "null", "5", '"s"', '{"a":1,"a":2}',
        json.dumps(OK) + " x", json.dumps(OK) + "] x", json.dumps(OK) + "} x",
        json.dumps(OK) + "," + json.dumps(OK), b'{"reading_id":"\xff"}', None,
    ],
)
def test_not_one_object_is_malformed(spark, payload):
    (reason, errors), = judge(spark, [payload])
    assert reason == C.MALFORMED and errors[0][0] == ""


def test_dead_letter_payload_is_valid_utf8(spark):
    row = C.dead_letters(C.validate(topic(spark, [b'{"a":"\xff"}'])), "readings").first()
    assert row.original_payload == '{"a":"�"}' and row.source_topic == "readings"


def test_threshold_is_strict(spark):
    rows = [{**OK, "temperature_c": t} for t in (85.0, 85.004)]
    a = C.accepted(C.validate(topic(spark, [json.dumps(r) for r in rows]))).orderBy("kafka_offset")
    assert [r.is_anomaly for r in a.collect()] == [False, True]


def test_machine_table_gives_the_same_routing_as_the_set(spark):
    payloads = [json.dumps(r) for r in readings() + violations()] + ["{bad"]
    from thermolake import settings

    machines = spark.createDataFrame([(m,) for m in settings.MACHINES] * 2, "machine_id string")
    by_set = C.validate(topic(spark, payloads))
    by_table = C.check_known_machines(
        C.validate(topic(spark, payloads), C.reading_contract(machines=None)), machines
    )
    pick = ["offset", "rejection_reason", F.col("errors.field").alias("f")]
    assert by_set.select(*pick).orderBy("offset").collect() == by_table.select(*pick).orderBy("offset").collect()


TEMPERATURES: list[Any] = [
    70, 70.5, " 70.5 ", "1_0.5", "1e1", "+5", ".5", "5.", "inf", "nan", "-Infinity", "0x10", "",
    "  ", True, False, None, [1], {"a": 1}, "1__0", "_1", "1_", "abc", "1e400", " 5", "1d",
    "1f", "5\n", "1,000", "1e", "1._5", -50, 200, 200.01, -50.01, 9999.0, 12345678.0, 1e16, 1.5e20,
]
STAMPS: list[Any] = [
    "2024-03-01T08:00:00+00:00", "2024-03-01 08:00Z", "2024-03-01t08:00z", "2024-03-01_08:00:00",
    "2024-03-01T08:00:00.123456789+0530", "2024-02-30", "2024-03-01", "2024-03-01T24:00:00Z",
    "2024-03-01T08:00:60Z", "0000-01-01", "not-a-timestamp", "2024/03/01", "2024", "1709280000",
    "1709280000.5", "1709280000000", "-1709280000", 1709280000, 1709280000.25, 1709280000123,
    20000000000, 20000000001, -20000000001, True, None, [1], "", " 2024-03-01T08:00:00 ",
    "2024-03-01T08", "2024-03-01T08:00:00 +00:00", "2024-03-01T08:00:00+05",
    "2024-03-01T08:00:00+24:00", "2024-03-01T08:00:00-23:59", "2024-03-01T08:00:00,5Z",
    "2024-03-01T08:00:00.", "2024-3-1", "20240301", "20240301T080000", "2024-13-01",
    "2024-03-01T08:61:00", "abc", "2024-03-01T08:00:00.1234567", "2024-03-01T08:00:00−05:00",
    "1e9", " 1709280000", "+1709280000", "1_709_280_000", 1e20, "99999999999999999", -1e15,
    "2024-03-01T", "2024-03-01T08:00:00.123Z", 0, -1.5, "253402300800", 253402300799,
]
OTHERS: list[dict] = [
    {**OK, "reading_id": v} for v in (5, None, "", "  ", " x ", " x", True, [1])
] + [
    {**OK, "machine_id": v} for v in (" CNC_MILL_01 ", "cnc_mill_01", "GHOST", 5, None)
] + [
    {**OK, "z": 1, "b": 2}, {"reading_id": "a"}, {}, {"z": None},
]


def expected_errors(case, types, machines):
    """What each declared field of the contract should report, judged value by value.

    Coercion is judged by the public library; the texts of the two rules on values are literals.
    """
    names = [field.name for field in C.reading_contract()]
    errors, values = [(key, "Extra inputs are not permitted") for key in case if key not in names], {}
    for name in names:
        if name not in case:
            errors.append((name, "Field required"))
            continue
        try:
            value = values[name] = types[name].validate_python(case[name])
        except ValueError as exc:
            errors += [(name, problem["msg"]) for problem in exc.errors()]
            continue
        if name == "machine_id" and value not in machines:
            errors.append((name, f"Value error, unknown machine_id '{value}'; expected one of {list(machines)}"))
        if name == "temperature_c" and not (value >= -50 and value <= 200):
            errors.append((name, f"Value error, temperature_c {value} outside plausible range [-50, 200]"))
    return sorted(errors), values


def test_every_field_agrees_with_its_judge(spark):
    pydantic = pytest.importorskip("pydantic")
    from thermolake import settings

    strip = pydantic.ConfigDict(str_strip_whitespace=True)
    adapt = lambda kind, config=None: pydantic.TypeAdapter(kind, config=config)
    types = {
        "reading_id": adapt(Annotated[str, pydantic.StringConstraints(strip_whitespace=True, min_length=1)]),
        "machine_id": adapt(str, strip),
        "temperature_c": adapt(float),
        "recorded_at": adapt(datetime),
    }
    assert list(types) == [field.name for field in C.reading_contract()]
    cases = OTHERS + [{**OK, "temperature_c": t} for t in TEMPERATURES] + [{**OK, "recorded_at": a} for a in STAMPS]
    checked = C.validate(topic(spark, [json.dumps(c) for c in cases])).orderBy("offset")
    rows = checked.withColumn("us", F.unix_micros("recorded_at")).drop("recorded_at").collect()
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    for case, row in zip(cases, rows, strict=True):
        errors, values = expected_errors(case, types, settings.MACHINES)
        assert sorted((e.field, e.error) for e in row.errors) == errors, case
        if errors:
            assert row.rejection_reason == C.INVALID
            continue
        at = values["recorded_at"]
        at = at if at.tzinfo else at.replace(tzinfo=UTC)
        assert row.rejection_reason is None
        assert row.us == (at - epoch) // timedelta(microseconds=1), case
        assert all(row[name] == values[name] for name in ("reading_id", "machine_id", "temperature_c")), case
