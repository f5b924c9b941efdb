"""Bronze, Silver and Gold as DataFrame transformations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake import settings
from thermolake.functions.numbers import cents, from_cents, mean_2dp, ratio_4dp
from thermolake.operators.topk import top_k

BUSINESS_KEY = "reading_id"

# The columns and types of the accepted, Bronze, Silver and Gold rows.
ACCEPTED_SCHEMA = T.StructType(
    [
        T.StructField("reading_id", T.StringType(), False),
        T.StructField("machine_id", T.StringType(), False),
        T.StructField("temperature_c", T.DoubleType(), False),
        T.StructField("recorded_at", T.TimestampType(), False),
        T.StructField("is_anomaly", T.BooleanType(), False),
        T.StructField("kafka_partition", T.IntegerType(), False),
        T.StructField("kafka_offset", T.LongType(), False),
    ]
)
BRONZE_SCHEMA = T.StructType(
    [*ACCEPTED_SCHEMA.fields, T.StructField("ingested_at", T.TimestampType(), False)]
)
SILVER_SCHEMA = T.StructType(
    [
        T.StructField("reading_id", T.StringType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("reading_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)
GOLD_SCHEMA = T.StructType(
    [
        T.StructField("machine_id", T.StringType()),
        T.StructField("reading_date", T.DateType()),
        T.StructField("readings", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("avg_temperature_c", T.DoubleType()),
        T.StructField("max_temperature_c", T.DoubleType()),
        T.StructField("min_temperature_c", T.DoubleType()),
        T.StructField("anomaly_rate", T.DoubleType()),
        T.StructField("temp_spread_c", T.DoubleType()),
    ]
)


class NotAnAggregate(AssertionError):
    """Gold has as many rows as Silver."""


def bronze(accepted: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Accepted records plus an ingestion timestamp, one row per delivered message."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return accepted.withColumn("ingested_at", stamp).select(BRONZE_SCHEMA.names)


def latest_per_key(rows: DataFrame, key: str = BUSINESS_KEY) -> DataFrame:
    """One row per key: highest offset, then latest ingestion.

    The remaining order columns only make exact ties repeatable. Offsets are comparable inside
    one partition, which is where all messages of a machine are.
    """
    order = [
        F.desc("kafka_offset"),
        F.desc("ingested_at"),
        F.desc("kafka_partition"),
        F.desc("temperature_c"),
    ]
    return top_k(rows, [key], order, 1, "_rn").drop("_rn")


def clean(
    bronze_rows: DataFrame, threshold: float = settings.ANOMALY_THRESHOLD_C
) -> DataFrame:
    """Bronze -> Silver rows.

    ``status`` judges the rounded temperature while ``is_anomaly`` keeps the verdict on the raw
    one; both are carried because they can disagree (85.004).
    """
    degrees = F.round("temperature_c", 2)
    label = F.when(degrees > threshold, F.lit("ANOMALY")).otherwise(F.lit("NORMAL"))
    derived = {
        "machine_id": F.upper(F.trim("machine_id")),
        "temperature_c": degrees,
        "reading_date": F.col("recorded_at").cast("date"),
        "status": label,
    }
    columns = [derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in SILVER_SCHEMA]
    return latest_per_key(bronze_rows).select(*columns)


def clean_touched(bronze_rows: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Silver rows of the keys a new batch touches, recomputed from all of their deliveries.

    Silver holds no offsets, so a late but older delivery cannot be recognised there.
    """
    touched = new_rows.select(BUSINESS_KEY).distinct()
    return clean(bronze_rows.join(touched, BUSINESS_KEY, "left_semi"))


def kpi_partials(silver: DataFrame) -> DataFrame:
    """Counts, integer sums and extremes per machine and day, which add up over parts of the rows.

    Partial sums are combined before the shuffle, so a machine holding a third of the readings costs
    one row per map task.
    """
    c = cents(F.col("temperature_c"))
    return silver.groupBy("machine_id", "reading_date").agg(
        F.count(F.lit(1)).alias("readings"),
        F.sum(F.col("is_anomaly").cast("int")).alias("anomaly_count"),
        F.sum(c).alias("sum_cents"),
        F.max(c).alias("max_cents"),
        F.min(c).alias("min_cents"),
    )


def kpis(partials: DataFrame) -> DataFrame:
    """Gold rows. The mean comes from integer cents and is therefore exact."""
    return partials.select(
        "machine_id",
        "reading_date",
        "readings",
        "anomaly_count",
        mean_2dp(F.col("sum_cents"), F.col("readings")).alias("avg_temperature_c"),
        from_cents(F.col("max_cents")).alias("max_temperature_c"),
        from_cents(F.col("min_cents")).alias("min_temperature_c"),
        ratio_4dp(F.col("anomaly_count"), F.col("readings")).alias("anomaly_rate"),
        from_cents(F.col("max_cents") - F.col("min_cents")).alias("temp_spread_c"),
    )


def daily_kpis(silver: DataFrame) -> DataFrame:
    """One row per machine and day."""
    return kpis(kpi_partials(silver))


def reduction_check(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: Silver rows, Gold rows and whether Gold is smaller."""
    sides = (
        silver.agg(F.count(F.lit(1)).alias("silver_rows"), F.lit(0).cast("bigint").alias("gold_rows"))
    ).unionByName(
        gold.agg(F.lit(0).cast("bigint").alias("silver_rows"), F.count(F.lit(1)).alias("gold_rows"))
    )
    totals = sides.agg(F.sum("silver_rows").alias("silver_rows"), F.sum("gold_rows").alias("gold_rows"))
    return totals.withColumn("is_reduced", F.col("gold_rows") < F.col("silver_rows"))


def require_reduction(silver: DataFrame, gold: DataFrame) -> None:
    """Audit for a Gold snapshot, run before it is published."""
    row = reduction_check(silver, gold).first()
    if not row["is_reduced"]:
        raise NotAnAggregate(
            f"Gold has {row['gold_rows']} rows for {row['silver_rows']} Silver rows"
        )


def distinct_keys(rows: DataFrame, key: str = BUSINESS_KEY) -> DataFrame:
    """Row count, exact and approximate key count."""
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct(key).alias("distinct_keys")
    )


def approx_distinct_keys(rows: DataFrame, key: str = BUSINESS_KEY, rsd: float = 0.02) -> DataFrame:
    """Key count from a fixed-size sketch, for monitoring."""
    return rows.agg(F.approx_count_distinct(key, rsd).alias("approx_distinct_keys"))


def lookup(rows: DataFrame, value: object, key: str = BUSINESS_KEY) -> DataFrame:
    """Rows of one key; the filter reaches the Parquet scan."""
    return rows.filter(F.col(key) == F.lit(value))
