"""Streaming ingestion: contract check, Bronze append, dead-letter sink, one log row per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake.operators import contract as C
from thermolake.operators.medallion import BRONZE_SCHEMA, bronze
from thermolake.sources.kafka import TOPIC_DDL, write_options
from thermolake.sources.tables import check_schema, with_required

LOG_DDL = "batch_id bigint, accepted bigint, rejected bigint"


class EmptyIngest(RuntimeError):
    """No record was accepted."""


def file_topic(spark: SparkSession, path: str) -> DataFrame:
    """A topic kept as JSON files with the same columns (``value`` and ``key`` as text)."""
    ddl = TOPIC_DDL.replace("binary", "string")
    return spark.readStream.schema(ddl).json(path)


def kafka_dead_letters(bootstrap: str, topic: str) -> Callable[[DataFrame, int], None]:
    """An extra sink sending envelopes to a topic, with the batch id as a header for retries."""

    def send(letters: DataFrame, batch_id: int) -> None:
        headers = F.array(
            F.struct(F.lit("batch_id").alias("key"), F.lit(str(batch_id)).cast("binary").alias("value"))
        )
        (
            letters.select(F.to_json(F.struct("*")).alias("value"), headers.alias("headers"))
            .write.format("kafka")
            .options(**write_options(bootstrap, topic))
            .option("includeHeaders", "true")
            .save()
        )

    return send


def ingest(
    records: DataFrame,
    out: str,
    checkpoint: str,
    source_topic: str,
    contract: list[C.Field] | None = None,
    dead_letter_sink: Callable[[DataFrame, int], None] | None = None,
) -> dict:
    """Drain what the stream holds now and return the counts of this drain.

    A batch writes its own folders in overwrite mode, so a batch repeated after a failure
    replaces its first attempt instead of adding to it. The reader's progress is committed after
    both sinks. Raises ``EmptyIngest`` when this drain accepted nothing, whatever earlier ones
    did; ``ingest_totals`` has the counts over all of them.
    """
    handled: set[int] = set()

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = C.validate(batch, contract).persist()
        try:
            rows = bronze(C.accepted(checked))
            check_schema(rows, BRONZE_SCHEMA)
            with_required(rows, BRONZE_SCHEMA).write.mode("overwrite").parquet(
                f"{out}/bronze/ingest_batch={batch_id}"
            )
            letters = C.dead_letters(checked, source_topic)
            letters.write.mode("overwrite").json(f"{out}/dead_letters/ingest_batch={batch_id}")
            if dead_letter_sink is not None:
                dead_letter_sink(letters, batch_id)
            counts = C.routing_counts(checked).first()
            batch.sparkSession.createDataFrame(
                [(batch_id, counts["accepted"], counts["rejected"])], LOG_DDL
            ).coalesce(1).write.mode("overwrite").json(f"{out}/ingest_log/ingest_batch={batch_id}")
            handled.add(batch_id)
        finally:
            checked.unpersist()

    query = (
        records.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    counts = ingest_totals(records.sparkSession, out, handled)
    if counts["accepted"] == 0:
        raise EmptyIngest("ingestion produced no valid records")
    return counts


def ingest_totals(spark: SparkSession, out: str, batches: set[int] | None = None) -> dict:
    """Accepted and rejected records of these batches, or of all."""
    try:
        log = spark.read.schema(LOG_DDL).json(f"{out}/ingest_log")
        if batches is not None:
            log = log.filter(F.col("batch_id").isin(sorted(batches)) if batches else F.lit(False))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return {"accepted": 0, "rejected": 0}
    sums = log.agg(
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"),
    )
    return sums.first().asDict()


def read_bronze(spark: SparkSession, out: str) -> DataFrame:
    """All delivered rows; ``ingest_batch`` is the partition column and prunes."""
    schema = T.StructType([*BRONZE_SCHEMA.fields, T.StructField("ingest_batch", T.LongType())])
    return spark.read.schema(schema).parquet(f"{out}/bronze")
