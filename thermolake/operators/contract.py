"""Contract check of raw JSON readings as column expressions.

One narrow projection adds the typed fields and *all* errors of a record, so routing is two
filters on the same DataFrame and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake import settings
from thermolake.functions import lax
from thermolake.functions.numbers import float_text

MALFORMED = "malformed_json"
INVALID = "schema_validation_failed"

ERRORS_TYPE = "array<struct<field:string,error:string>>"

DLQ_SCHEMA = T.StructType(
    [
        T.StructField("rejected_at", T.TimestampType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("rejection_reason", T.StringType()),
        T.StructField(
            "validation_error",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("field", T.StringType()),
                        T.StructField("error", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("original_payload", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Field:
    """One declared field: its lax coercion and a rule, ``column -> (holds, error text)``."""

    name: str
    coerce: Callable[[DataFrame, str], tuple[DataFrame, Column]]
    rule: Callable[[Column], tuple[Column, Column]] | None = None


# The texts of the two rules on values.
def in_set(allowed: Iterable[str]) -> Callable[[Column], tuple[Column, Column]]:
    """Exact-case membership in a small fixed set."""
    values = list(dict.fromkeys(allowed))
    listing = "[" + ", ".join(f"'{v}'" for v in values) + "]"
    return lambda c: (
        c.isin(values),
        F.concat(F.lit("Value error, unknown machine_id '"), c, F.lit(f"'; expected one of {listing}")),
    )


def in_range(name: str, low: float, high: float) -> Callable[[Column], tuple[Column, Column]]:
    """Inclusive range; NaN is outside it."""
    return lambda c: (
        c.between(low, high) & ~F.isnan(c),
        F.concat(
            F.lit(f"Value error, {name} "),
            float_text(c),
            F.lit(f" outside plausible range [{low:g}, {high:g}]"),
        ),
    )


def reading_contract(
    machines: Iterable[str] | None = settings.MACHINES,
    low: float = settings.TEMPERATURE_MIN_C,
    high: float = settings.TEMPERATURE_MAX_C,
) -> list[Field]:
    """Fields of a reading; ``machines=None`` leaves the set to ``check_known_machines``."""
    return [
        Field("reading_id", lax.non_empty_string),
        Field("machine_id", lax.lax_string, in_set(machines) if machines is not None else None),
        Field("temperature_c", lax.lax_double, in_range("temperature_c", low, high)),
        Field("recorded_at", lax.lax_timestamp),
    ]


def with_object(records: DataFrame, payload: str) -> DataFrame:
    """Add ``_object`` (VARIANT) and ``_keys``, the latter null unless the payload is one object.

    The parser stops after the first value, so the text is wrapped: ``{} x`` then fails. Text
    that could close the wrapper itself holds a ``]``, and is tried in a second wrapper too.
    """
    text, boxed = F.col("_text"), F.col("_boxed")
    closed = F.when(
        F.contains(text, F.lit("]")),
        F.try_parse_json(F.concat(F.lit('{"p":'), text, F.lit("}"))).isNotNull(),
    ).otherwise(True)
    single = F.try_variant_get(boxed, "$[1]", "variant").isNull()
    return (
        records.withColumn("_text", F.col(payload).cast("string"))
        .withColumn(
            "_boxed",
            F.when(
                F.is_valid_utf8(text) & closed,
                F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))),
            ),
        )
        .withColumn("_object", F.when(single, F.try_variant_get(boxed, "$[0]", "variant")))
        .withColumn("_keys", F.map_keys(F.try_variant_get("_object", "$", "map<string,variant>")))
        .drop("_text", "_boxed")
    )


def validate(
    records: DataFrame, contract: list[Field] | None = None, payload: str = "value"
) -> DataFrame:
    """Add the typed fields, ``errors`` and ``rejection_reason`` (null when accepted)."""
    contract = contract or reading_contract()
    names = [f.name for f in contract]

    typed = (
        with_object(records, payload)
        .withColumns({f"_raw_{n}": F.try_variant_get("_object", f"$.{n}", "variant") for n in names})
        .withColumns({f"_kind_{n}": F.schema_of_variant(F.col(f"_raw_{n}")) for n in names})
    )
    found, clean = [], F.lit(True)
    for field in contract:
        typed, error = field.coerce(typed, field.name)
        value = F.col(field.name)
        error = F.when(value.isNull(), error)
        if field.rule is not None:
            # A rule only speaks about values whose type already passed.
            holds, text = field.rule(value)
            typed = typed.withColumn(f"_ok_{field.name}", value.isNotNull() & holds)
            error = error.when(~holds, text)
        else:
            typed = typed.withColumn(f"_ok_{field.name}", value.isNotNull())
        clean &= F.col(f"_ok_{field.name}")
        found.append(F.struct(F.lit(field.name).alias("field"), error.alias("error")))

    unknown = F.array_except(F.col("_keys"), F.array(*[F.lit(n) for n in names]))
    typed = typed.withColumn("_extra", unknown).withColumn("_clean", clean & (F.size("_extra") == 0))
    extras = F.transform(
        "_extra", lambda key: F.struct(key.alias("field"), F.lit(lax.EXTRA).alias("error"))
    )
    malformed = F.array(
        F.struct(F.lit("").alias("field"), F.lit("payload is not one JSON object").alias("error"))
    )
    errors = (
        F.when(F.col("_keys").isNull(), malformed)
        .when(F.col("_clean"), F.array().cast(ERRORS_TYPE))
        .otherwise(F.concat(F.filter(F.array(*found), lambda e: e["error"].isNotNull()), extras))
        .cast(ERRORS_TYPE)
    )
    # spark_partition_id() counts as non-deterministic, which keeps a filter on the reason above
    # this projection. Pushed down, it would be rewritten in terms of the raw payload, with every
    # step above repeated many times over.
    reason = (
        F.when(F.spark_partition_id() < 0, F.lit(None))
        .when(F.col("_keys").isNull(), MALFORMED)
        .when(~F.col("_clean"), INVALID)
    )
    checked = typed.withColumn("errors", errors).withColumn("rejection_reason", reason)
    return checked.select(*records.columns, *names, "errors", "rejection_reason")


def check_known_machines(validated: DataFrame, machines: DataFrame) -> DataFrame:
    """Membership when the allowed set is a table with a ``machine_id`` column.

    A left join: Spark broadcasts the table when its size allows and otherwise joins by key with
    AQE splitting hot machines. Rows whose id already failed keep their own error and take a
    scattered key, so they do not all meet in one partition.
    """
    allowed = machines.select(F.col("machine_id").alias("_allowed")).distinct()
    key = F.coalesce("machine_id", F.concat(F.lit("\u0000"), F.monotonically_increasing_id()))
    joined = validated.withColumn("_probe", key).join(
        allowed, F.col("_probe") == F.col("_allowed"), "left"
    )
    unknown = F.col("machine_id").isNotNull() & F.col("_allowed").isNull()
    error = F.array(
        F.struct(
            F.lit("machine_id").alias("field"),
            F.concat(F.lit("Value error, unknown machine_id '"), F.col("machine_id"), F.lit("'")).alias("error"),
        )
    )
    return (
        joined.withColumn("errors", F.when(unknown, F.concat("errors", error)).otherwise(F.col("errors")))
        .withColumn(
            "rejection_reason",
            F.coalesce("rejection_reason", F.when(unknown, F.lit(INVALID))),
        )
        .drop("_probe", "_allowed")
    )


def accepted(
    validated: DataFrame, threshold: float = settings.ANOMALY_THRESHOLD_C
) -> DataFrame:
    """Accepted records; ``is_anomaly`` judges the raw temperature, strictly above."""
    return validated.filter(F.col("rejection_reason").isNull()).select(
        "reading_id",
        "machine_id",
        "temperature_c",
        "recorded_at",
        (F.col("temperature_c") > threshold).alias("is_anomaly"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
    )


def dead_letters(validated: DataFrame, source_topic: str, payload: str = "value") -> DataFrame:
    """Rejected records as dead-letter envelopes (``DLQ_SCHEMA``)."""
    return validated.filter(F.col("rejection_reason").isNotNull()).select(
        F.current_timestamp().alias("rejected_at"),
        F.lit(source_topic).alias("source_topic"),
        "rejection_reason",
        F.col("errors").alias("validation_error"),
        F.make_valid_utf8(F.col(payload).cast("string")).alias("original_payload"),
    )


def routing_counts(validated: DataFrame) -> DataFrame:
    """One row: ``accepted``, ``rejected``."""
    return validated.agg(
        F.count_if(F.col("rejection_reason").isNull()).alias("accepted"),
        F.count_if(F.col("rejection_reason").isNotNull()).alias("rejected"),
    )


def error_counts(validated: DataFrame) -> DataFrame:
    """Rejections by reason and field."""
    return (
        validated.filter(F.col("rejection_reason").isNotNull())
        .select("rejection_reason", F.explode("errors.field").alias("field"))
        .groupBy("rejection_reason", "field")
        .agg(F.count(F.lit(1)).alias("errors"))
    )
