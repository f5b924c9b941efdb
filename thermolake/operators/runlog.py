"""Analytics over run events (START / COMPLETE / FAIL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_DDL = (
    "eventType string, eventTime string, "
    "run struct<runId:string, facets:struct<errorMessage:struct<message:string, programmingLanguage:string>>>, "
    "job struct<namespace:string, name:string>, producer string, schemaURL string"
)

# Fields every event must carry, and the event types.
REQUIRED_FIELDS = ("eventType", "eventTime", "run.runId", "job.namespace", "job.name", "producer")
EVENT_TYPES = ("START", "COMPLETE", "FAIL")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event JSON lines with the declared schema (``eventTime`` parsed to a timestamp); a broken line
    fails the job that reads it."""
    events = spark.read.schema(EVENT_DDL).option("mode", "FAILFAST").json(path)
    return events.withColumn("eventTime", F.col("eventTime").cast("timestamp"))


def run_status(events: DataFrame) -> DataFrame:
    """One row per run: status (``OPEN`` without a final event) and duration in milliseconds."""
    started = F.min(F.when(F.col("eventType") == "START", F.col("eventTime")))
    ended = F.max(F.when(F.col("eventType").isin("COMPLETE", "FAIL"), F.col("eventTime")))
    runs = events.groupBy(
        F.col("run.runId").alias("run_id"), F.col("job.name").alias("job_name")
    ).agg(
        started.alias("started_at"),
        ended.alias("ended_at"),
        F.count_if(F.col("eventType") == "FAIL").alias("_fails"),
        F.count_if(F.col("eventType") == "COMPLETE").alias("_completes"),
    )
    status = F.when(F.col("_fails") > 0, "FAIL").when(F.col("_completes") > 0, "COMPLETE").otherwise("OPEN")
    millis = F.call_function(
        "div", F.unix_micros("ended_at") - F.unix_micros("started_at"), F.lit(1000)
    )
    return runs.select(
        "run_id", "job_name", status.alias("status"), "started_at", "ended_at", millis.alias("duration_ms")
    )


def run_errors(events: DataFrame) -> DataFrame:
    """Error message of every failed run."""
    message = F.col("run.facets.errorMessage")
    return events.filter(F.col("eventType") == "FAIL").select(
        F.col("run.runId").alias("run_id"),
        F.col("job.name").alias("job_name"),
        message["message"].alias("message"),
        message["programmingLanguage"].alias("programming_language"),
    )


def conformance(events: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Events and missing values per required field, from one aggregation."""
    counted = events.agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col(f).isNull()).alias(f"_m{i}") for i, f in enumerate(fields)],
    )
    rows = [
        F.struct(
            F.lit(f).alias("field"),
            F.col("events").alias("events"),
            F.col(f"_m{i}").alias("missing"),
            (F.col(f"_m{i}") == 0).alias("conforms"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*rows)))


def events_per_job(events: DataFrame) -> DataFrame:
    """Events per job, one column per event type."""
    types = list(EVENT_TYPES)
    return (
        events.groupBy(F.col("job.name").alias("job_name"))
        .pivot("eventType", types)
        .agg(F.count(F.lit(1)))
        .fillna(0, subset=types)
        .select("job_name", *[F.col(t).alias(t.lower()) for t in types])
    )
