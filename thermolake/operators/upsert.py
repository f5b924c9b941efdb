"""Keyed upsert, its metrics, and the audit that compares two states of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermolake.operators.incremental import add_up, fingerprints


class AmbiguousSource(ValueError):
    """The upsert source holds a key more than once."""


class UpsertNotProven(AssertionError):
    """The published state is not target plus source."""


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held more than once, with their row count."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter("row_count > 1")


def require_unique(source: DataFrame, key: str) -> None:
    """Raise when a merge of this source would be ambiguous."""
    examples = [r[0] for r in duplicate_keys(source, [key]).select(key).take(5)]
    if examples:
        raise AmbiguousSource(f"source holds duplicate {key} values, e.g. {examples}")


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Matched rows are replaced, new rows added, all other target rows kept.

    Anti join and union rather than a full outer join: a source small enough for broadcasting
    leaves the target unshuffled.
    """
    kept = target.join(source.select(key), key, "left_anti")
    return kept.unionByName(source.select(target.columns))


def upsert_metrics(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: rows before and after, updated and inserted."""
    hit = source.select(key).withColumn("_hit", F.lit(1))
    zero = F.lit(0).cast("bigint")
    sides = (
        target.select(key)
        .join(hit, key, "left")
        .agg(
            F.count(F.lit(1)).alias("rows_before"),
            F.count("_hit").alias("rows_updated"),
            zero.alias("rows_source"),
        )
        .unionByName(
            source.agg(
                zero.alias("rows_before"),
                zero.alias("rows_updated"),
                F.count(F.lit(1)).alias("rows_source"),
            )
        )
    )
    totals = sides.agg(*[F.sum(c).alias(c) for c in sides.columns])
    return totals.select(
        F.lit("merge").alias("operation"),
        "rows_before",
        "rows_updated",
        (F.col("rows_source") - F.col("rows_updated")).alias("rows_inserted"),
        (F.col("rows_before") + F.col("rows_source") - F.col("rows_updated")).alias("rows_after"),
    )


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per changed key: ``inserted``, ``deleted`` or ``updated`` with old and new values."""
    old = before.select(key, *[F.col(c).alias(f"before_{c}") for c in columns], F.lit(1).alias("_b"))
    new = after.select(key, *[F.col(c).alias(f"after_{c}") for c in columns], F.lit(1).alias("_a"))
    differs = F.lit(False)
    for c in columns:
        differs |= ~F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    change = (
        F.when(F.col("_b").isNull(), "inserted")
        .when(F.col("_a").isNull(), "deleted")
        .when(differs, "updated")
    )
    return (
        old.join(new, key, "full_outer")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .drop("_a", "_b")
    )


def change_diff(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The diff that an upsert of ``source`` makes, from the change batch and the rows it touches.

    The target is read once and not shuffled when the batch can be broadcast.
    """
    new = source.select(key, *[F.col(c).alias(f"after_{c}") for c in columns])
    old = target.select(key, *[F.col(c).alias(f"before_{c}") for c in columns], F.lit(1).alias("_b"))
    touched = old.join(source.select(key), key, "left_semi")
    differs = F.lit(False)
    for c in columns:
        differs |= ~F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
    change = F.when(F.col("_b").isNull(), "inserted").when(differs, "updated")
    joined = new.join(touched, key, "left").withColumn("change", change).filter(F.col("change").isNotNull())
    names = [f"{side}_{c}" for side in ("before", "after") for c in columns]
    return joined.select(key, *names, "change")


def prove_upsert(before: DataFrame, source: DataFrame, after: DataFrame, key: str) -> dict:
    """Check on the published rows: unique keys, the expected total, source values in place."""
    expected = upsert_metrics(before, source, key).first()
    seen = after.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("row_count"), F.count_if(F.col("n") > 1).alias("repeated")
    ).first()
    # What is there must be what was there, less the replaced rows, plus the source: by hash sums, which
    # one aggregation of each frame gives.
    everything = lambda rows: fingerprints(rows.select(after.columns).withColumn("_all", F.lit(0)), "_all")
    replaced = before.join(source.select(key), key, "left_semi")
    left = add_up([(1, everything(before)), (-1, everything(replaced)), (1, everything(source)), (-1, everything(after))], "_all")
    problems = []
    if seen["repeated"]:
        problems.append(f"{seen['repeated']} keys occur more than once")
    if (seen["row_count"] or 0) != expected["rows_after"]:
        problems.append(f"{seen['row_count']} rows instead of {expected['rows_after']}")
    if not left.isEmpty():
        problems.append("source rows are missing")
    if problems:
        raise UpsertNotProven("; ".join(problems))
    return expected.asDict()


def merge_into(spark: SparkSession, table: str, source: DataFrame, key: str) -> None:
    """The same upsert through MERGE, for tables whose catalog supports row-level changes.

    This rewrites only the files it touches; plain Parquet tables refuse it.
    """
    updates = [c for c in source.columns if c != key]
    spark.sql(
        f"MERGE INTO {table} AS t USING {{source}} AS s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.{c} = s.{c}' for c in updates)} "
        "WHEN NOT MATCHED THEN INSERT *",
        source=source,
    )
