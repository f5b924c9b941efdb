"""Session settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# The zone decides to_date() and offset-less timestamps; AQE sizes shuffles, so no width is
# hard-coded here.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on a session that somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "thermolake", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting of the session for the jobs that are planned inside."""
    usual = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only when a local master has none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="thermolake-"))
    return spark.sparkContext.getCheckpointDir()


def materialise(rows: DataFrame, name: str) -> DataFrame:
    """Write rows into the shared checkpoint folder and read them back.

    Lineage ends here, and Spark knows the real size, so it decides itself what to broadcast.
    """
    spark = rows.sparkSession
    path = f"{checkpoint_dir(spark)}/thermolake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
