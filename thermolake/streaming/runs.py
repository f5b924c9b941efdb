"""Runs followed in a stream: START paired with its end, and runs that are overdue.

State is kept per run until its end has been reported, so it is bounded by the runs that are open. Event
time decides: a run without an end is reported as ``OVERDUE`` once the watermark has passed its start by
the given time, and with its final status when the end arrives after all. An end whose START does
not come in that time is reported without a start. A run ends once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from thermolake.operators.runlog import EVENT_DDL

OUTCOME_DDL = "run_id string, job_name string, status string, started bigint, ended bigint"
STATE_DDL = "started bigint, ended bigint, failed boolean"


def file_events(spark: SparkSession, path: str) -> DataFrame:
    """Run events kept as files of JSON lines; a broken line fails the batch that reads it."""
    events = spark.readStream.schema(EVENT_DDL).option("mode", "FAILFAST").json(path)
    return events.withColumn("eventTime", F.col("eventTime").cast("timestamp"))


def outcomes(events: DataFrame, overdue_after_seconds: int, lateness: str = "0 seconds") -> DataFrame:
    """A stream of ``OUTCOME_DDL`` rows (times in microseconds) from a stream of events."""
    wait = overdue_after_seconds * 1_000_000

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        started, ended, failed = state.get if state.exists else (None, None, False)
        status = None
        if state.hasTimedOut:
            status = "OVERDUE" if ended is None else ("FAIL" if failed else "COMPLETE")
        else:
            for frame in frames:
                starts = frame.loc[frame["kind"] == "START", "micros"]
                ends = frame.loc[frame["kind"] != "START", "micros"]
                if len(starts):
                    started = min(int(starts.min()), started if started is not None else int(starts.min()))
                if len(ends):
                    ended = max(int(ends.max()), ended if ended is not None else int(ends.max()))
                    failed = failed or bool((frame["kind"] == "FAIL").any())
            if started is not None and ended is not None:
                status = "FAIL" if failed else "COMPLETE"
        if status in ("FAIL", "COMPLETE"):
            state.remove()
        else:
            state.update((started, ended, failed))
            if status is None:
                due = ((started if started is not None else ended) + wait) // 1000
                state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if status is not None:
            row = (key[0], key[1], status, started, ended)
            yield pd.DataFrame([row], columns=["run_id", "job_name", "status", "started", "ended"]).astype({"started": "Int64", "ended": "Int64"})

    wanted = events.filter(F.col("eventType").isin("START", "COMPLETE", "FAIL") & F.col("eventTime").isNotNull())
    keyed = wanted.withWatermark("eventTime", lateness).select(
        F.col("run.runId").alias("run_id"),
        F.col("job.name").alias("job_name"),
        F.col("eventType").alias("kind"),
        F.unix_micros("eventTime").alias("micros"),
        "eventTime",
    )
    return keyed.groupBy("run_id", "job_name").applyInPandasWithState(
        follow, OUTCOME_DDL, STATE_DDL, "append", GroupStateTimeout.EventTimeTimeout
    )


def follow_runs(events: DataFrame, out: str, checkpoint: str, overdue_after_seconds: int, lateness: str = "0 seconds") -> None:
    """Drain what the stream holds now; outcomes go to ``out``, one folder per batch, so that a batch
    repeated after a failure replaces its first attempt."""

    def save(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        outcomes(events, overdue_after_seconds, lateness)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def reported(spark: SparkSession, out: str) -> DataFrame:
    """One row per reported run: its final status if there is one, else ``OVERDUE``."""
    rows = spark.read.schema(f"{OUTCOME_DDL}, batch bigint").parquet(out)
    last = F.max_by(F.struct("status", "started", "ended"), F.struct(F.col("status") != "OVERDUE", "batch"))
    best = rows.groupBy("run_id", "job_name").agg(last.alias("r"))
    return best.select(
        "run_id",
        "job_name",
        "r.status",
        F.timestamp_micros("r.started").alias("started_at"),
        F.timestamp_micros("r.ended").alias("ended_at"),
        F.call_function("div", F.col("r.ended") - F.col("r.started"), F.lit(1000)).alias("duration_ms"),
    )
