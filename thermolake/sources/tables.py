"""Keyed tables of the catalog: check, write, audit, publish.

Rows are checked against the declared schema, nulls included, and audited before the table is
touched, so a refused write changes nothing. Publishing is Spark's own overwrite: of the whole
table, or of the touched partitions (dynamic partition overwrite); partitions that lost their last
row are dropped by name. One writer per table is assumed. Where a catalog with row-level changes is
configured, ``operators.upsert.merge_into`` does the same at file level.

Counts come from the written rows, not from accumulators, which may count a repeated task twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake.operators.upsert import require_unique
from thermolake.session import materialise

LOG_DDL = "version bigint, operation string, metrics map<string,bigint>, published_at timestamp"


# An audit sees the whole table as it would be published, and raises to stop it.
Audit = Callable[[DataFrame], None]


class SchemaMismatch(ValueError):
    """Rows do not have the table's columns and types."""


class TableExists(ValueError):
    """A create found a table."""


class TableMissing(ValueError):
    """A read found no table."""


def check_schema(rows: DataFrame, expected: T.StructType) -> None:
    """Refuse other columns or types. A Parquet path write would accept them silently."""
    have = {f.name: f.dataType for f in rows.schema}
    want = {f.name: f.dataType for f in expected}
    if have != want:
        wrong = sorted(
            f"{n}: {have[n].simpleString() if n in have else 'absent'} "
            f"instead of {want[n].simpleString() if n in want else 'absent'}"
            for n in have.keys() | want.keys()
            if have.get(n) != want.get(n)
        )
        raise SchemaMismatch("; ".join(wrong))


def with_required(rows: DataFrame, expected: T.StructType) -> DataFrame:
    """Rows in the declared column order; a null in a non-null column fails the job that writes
    them, so no extra pass is needed and nothing is published."""

    def checked(field: T.StructField) -> Column:
        value = F.col(field.name)
        if field.nullable:
            return value
        problem = F.raise_error(f"{field.name} is null but declared non-null").cast(field.dataType)
        return F.when(value.isNull(), problem).otherwise(value).alias(field.name)

    return rows.select(*[checked(field) for field in expected])


def write_for_lookup(rows: DataFrame, key: str, path: str, files: int | None = None) -> DataFrame:
    """Store rows so that a lookup by key reads little: files hold ranges of the key, sorted, and a
    Bloom filter of its values, by which the reader skips row groups. Their number follows the size of
    the rows if ``files`` is not given."""
    ranged = rows.repartitionByRange(key) if files is None else rows.repartitionByRange(files, key)
    ordered = ranged.sortWithinPartitions(key)
    ordered.write.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class KeyedTable:
    """A keyed Parquet table of the session's catalog, written by Spark's own writers.

    An audit sees the rows before they are published; without one they are written directly.
    ``path`` keeps the files outside the warehouse.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: T.StructType,
        partition_by: str | None = None,
        path: str | None = None,
    ):
        self.spark, self.name, self.schema = spark, name, schema
        self.partition_by, self.path = partition_by, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        if not self.exists():
            raise TableMissing(f"{self.name} does not exist")
        return self.spark.table(self.name).select(self.schema.names)

    def history(self) -> DataFrame:
        """Operations with their counts, oldest first."""
        if not self.spark.catalog.tableExists(f"{self.name}_log"):
            return self.spark.createDataFrame([], LOG_DDL)
        return self.spark.table(f"{self.name}_log").orderBy("version")

    def last_operation(self) -> dict | None:
        row = self.history().orderBy(F.desc("version")).first()
        return row.asDict() if row else None

    def create(self, rows: DataFrame, audit: Audit | None = None) -> dict:
        """First write; refuses an existing table."""
        check_schema(rows, self.schema)
        if self.exists():
            raise TableExists(f"{self.name} already exists")
        self._save(self._audited(rows, audit), "errorifexists")
        return self._log("create", {"rows": self.read().count()})

    def overwrite(self, rows: DataFrame, audit: Audit | None = None) -> dict:
        """Replace the contents, for tables that are pure derivations."""
        check_schema(rows, self.schema)
        rows = self._audited(rows, audit)
        if self.exists():
            self._insert(materialise(rows, "overwrite") if audit is None else rows, "static")
        else:
            self._save(rows, "errorifexists")
        return self._log("overwrite", {"rows": self.read().count()})

    def upsert(self, source: DataFrame, key: str, audit: Audit | None = None) -> dict:
        """Create the table, or replace the rows of matching keys and add the new ones.

        Of a partitioned table only the partitions are rewritten that a changed row leaves or enters.
        """
        check_schema(source, self.schema)
        source = materialise(with_required(source, self.schema), "source")  # read several times
        require_unique(source, key)
        if not self.exists():
            return self.create(source, audit)
        target = self.read()
        affected, others = target, target.limit(0)
        if self.partition_by is not None:
            column = self.partition_by
            moved = target.join(source.select(key), key, "left_semi").select(column)
            touched = materialise(moved.unionByName(source.select(column)).distinct(), "touched")
            here = touched.withColumnRenamed(column, "_touched")
            same = F.col(column).eqNullSafe(F.col("_touched"))
            affected, others = target.join(here, same, "left_semi"), target.join(here, same, "left_anti")
        kept = affected.join(source.select(key), key, "left_anti")
        staged = materialise(kept.unionByName(source), "merged")
        if audit is not None:
            audit(others.unionByName(staged))
        before, rows_affected = target.count(), affected.count()
        written, rows_source = staged.count(), source.count()
        updated = rows_affected - (written - rows_source)
        self._insert(staged, "dynamic" if self.partition_by else "static")
        if self.partition_by is not None:
            self._drop_partitions(touched.join(staged.select(column).distinct(), column, "left_anti"))
        return self._log(
            "merge",
            {
                "rows": before - rows_affected + written,
                "rows_before": before,
                "rows_updated": updated,
                "rows_inserted": rows_source - updated,
                "rows_rewritten": written,
            },
        )

    def _audited(self, rows: DataFrame, audit: Audit | None) -> DataFrame:
        rows = with_required(rows, self.schema)
        if audit is None:
            return rows
        staged = materialise(rows, "staged")
        audit(staged)
        return staged

    def _save(self, rows: DataFrame, mode: str) -> None:
        writer = rows.write.format("parquet").mode(mode)
        if self.partition_by is not None:
            # Rebalancing gathers each partition value in few files, and AQE splits a value that
            # holds a third of the rows over several writers.
            writer = rows.hint("rebalance", self.partition_by).write.format("parquet").mode(mode)
            writer = writer.partitionBy(self.partition_by)
        if self.path is not None:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.name)

    def _insert(self, staged: DataFrame, mode: str) -> None:
        """Overwrite what ``staged`` covers: all of the table, or its partitions. The mode is a session
        setting, as writes into a catalog table do not take it as an option."""
        rows = staged.select(self.spark.table(self.name).columns)
        if self.partition_by is not None:
            rows = rows.hint("rebalance", self.partition_by)
        setting = "spark.sql.sources.partitionOverwriteMode"
        usual = self.spark.conf.get(setting)
        self.spark.conf.set(setting, mode)
        try:
            rows.write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(setting, usual)

    def _drop_partitions(self, emptied: DataFrame) -> None:
        """Drop partitions that lost their last row; each is one catalog call."""
        for row in emptied.select(F.col(self.partition_by).cast("string")).toLocalIterator():
            value = "null" if row[0] is None else "'" + row[0].replace("'", "\\'") + "'"
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({self.partition_by} = {value})")

    def _log(self, operation: str, metrics: dict[str, int]) -> dict:
        last = self.last_operation()
        version = 0 if last is None else last["version"] + 1
        entry = self.spark.createDataFrame([(version, operation, metrics, None)], LOG_DDL)
        writer = entry.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append")
        if self.path is not None:
            writer = writer.option("path", f"{self.path}_log")
        writer.saveAsTable(f"{self.name}_log")
        return {"version": version, "operation": operation, **metrics}
