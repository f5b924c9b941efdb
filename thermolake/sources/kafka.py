"""Kafka topics as DataFrames. Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Columns of a topic record, whatever carries it.
TOPIC_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)


def read_options(bootstrap: str, topic: str, max_offsets_per_trigger: int | None = None) -> dict:
    """From the earliest offset; progress lives in the query's checkpoint."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def write_options(bootstrap: str, topic: str) -> dict:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def read_topic(spark: SparkSession, bootstrap: str, topic: str, **kwargs) -> DataFrame:
    return spark.readStream.format("kafka").options(**read_options(bootstrap, topic, **kwargs)).load()


def keyed_messages(rows: DataFrame, key: str = "machine_id") -> DataFrame:
    """``key`` and JSON ``value``; one key stays in one partition, so its order is kept."""
    return rows.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def publish(rows: DataFrame, bootstrap: str, topic: str, key: str = "machine_id", fmt: str = "kafka") -> int:
    """Write keyed records and return how many were delivered."""
    seen = Observation()
    (
        keyed_messages(rows, key)
        .observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("append")
        .format(fmt)
        .options(**write_options(bootstrap, topic))
        .save()
    )
    return seen.get["n"]
