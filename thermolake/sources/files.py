"""JSON-lines sources and sinks."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake.operators.medallion import ACCEPTED_SCHEMA

# Microseconds survive the way through text.
TIMESTAMPS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


class EmptyInput(ValueError):
    """Nothing to load."""


class BrokenInput(ValueError):
    """Records that are no JSON, have a wrong type, or lack a required field."""


def write_json_lines(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).option("timestampFormat", TIMESTAMPS).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared schema; a line that does not fit it fails the job that reads it."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_accepted(
    spark: SparkSession, path: str, schema: T.StructType = ACCEPTED_SCHEMA
) -> DataFrame:
    """Accepted records with their declared schema.

    Missing and empty input raise, and so do broken lines and nulls in required fields: one pass
    over the records counts them before anything is loaded.
    """
    required = [f.name for f in schema if not f.nullable]
    nulls = [F.count_if(F.col(name).isNull()).alias(name) for name in required]
    try:
        rows = read_json_lines(spark, path, schema)
        found = rows.agg(F.count(F.lit(1)).alias("_rows"), *nulls).first()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path} not found: run the ingestion first") from exc
        raise
    except (PySparkException, Py4JJavaError) as exc:
        if "MALFORMED_RECORD" in str(exc):
            raise BrokenInput(f"{path} holds a line that is no accepted record") from exc
        raise
    if not found["_rows"]:
        raise EmptyInput(f"no accepted records in {path}")
    missing = {name: found[name] for name in required if found[name]}
    if missing:
        raise BrokenInput(f"records in {path} without a required field: {missing}")
    return rows


def write_report(report: DataFrame, path: str) -> None:
    """An evidence report as JSON lines, written where its rows are."""
    report.write.mode("overwrite").json(path)
