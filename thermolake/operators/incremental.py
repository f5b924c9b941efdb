"""State that adds up, so that a change batch is enough to bring a derived table up to date.

- Versions: what decides between deliveries of a key, kept beside Silver, which does not hold it. A
  batch is compared with the versions of its keys; Bronze is not read.
- KPI partials: counts, sums and extremes per machine and day. Changed rows are added and the rows
  they replace are taken off; a group that loses an extreme is computed again from its own rows.
- Fingerprints: order-free sums of row hashes per partition; equal sums mean equal rows, up to
  collisions of 64-bit hashes in two independent sums.
- Check states: violations per partition, which add up to a gate's report.
- Sketches: distinct keys per partition, merged for any range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake.functions.numbers import cents
from thermolake.operators import medallion as M
from thermolake.operators import quality as Q

# --- versions of Silver -------------------------------------------------------------------

# What orders the deliveries of a key, most important first.
VERSION_COLUMNS = ["kafka_offset", "ingested_at", "kafka_partition", "temperature_c"]


def versions(bronze_rows: DataFrame) -> DataFrame:
    """The key and the order columns of the delivery that counts, one row per key."""
    return M.latest_per_key(bronze_rows).select(M.BUSINESS_KEY, *VERSION_COLUMNS)


def newer_deliveries(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Bronze rows of a batch that replace what is known of their key: one per key, none for late ones.

    The join reads the versions of the batch's keys; a small batch is broadcast by Spark.
    """
    order = [F.col(c).alias(f"known_{c}") for c in VERSION_COLUMNS]
    latest = M.latest_per_key(batch)
    mine = known.join(latest.select(M.BUSINESS_KEY), M.BUSINESS_KEY, "left_semi").select(M.BUSINESS_KEY, *order)
    both = latest.join(mine, M.BUSINESS_KEY, "left")
    new = F.struct(*VERSION_COLUMNS)
    old = F.struct(*[F.col(f"known_{c}").alias(c) for c in VERSION_COLUMNS])
    return both.filter(F.col("known_kafka_offset").isNull() | (new > old)).select(batch.columns)


# --- KPIs ---------------------------------------------------------------------------------

GROUP = ["machine_id", "reading_date"]


def partials_after(partials: DataFrame, removed: DataFrame, added: DataFrame, silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new partials of the groups that a change touches, groups that have no rows left).

    ``removed`` and ``added`` are the old and the new Silver rows of the changed keys, ``silver`` the
    table after the change: of it, only groups are read that lost their greatest or least value.
    """
    less, more = M.kpi_partials(removed), M.kpi_partials(added)
    of = lambda rows, name: rows.select(*GROUP, F.struct("readings", "anomaly_count", "sum_cents", "max_cents", "min_cents").alias(name))
    touched = of(less, "less").join(of(more, "more"), GROUP, "full_outer").join(of(partials, "old"), GROUP, "left")

    def total(name: str) -> Column:
        part = lambda side: F.coalesce(F.col(f"{side}.{name}"), F.lit(0))
        return (part("old") - part("less") + part("more")).alias(name)

    lost = (F.col("less.max_cents") >= F.col("old.max_cents")) | (F.col("less.min_cents") <= F.col("old.min_cents"))
    # A lost extreme that the new rows reach as well is none.
    regained = (F.coalesce(F.col("more.max_cents") >= F.col("old.max_cents"), F.lit(False)) | (F.col("less.max_cents") < F.col("old.max_cents"))) & (
        F.coalesce(F.col("more.min_cents") <= F.col("old.min_cents"), F.lit(False)) | (F.col("less.min_cents") > F.col("old.min_cents"))
    )
    merged = touched.select(
        *GROUP,
        total("readings"),
        total("anomaly_count"),
        total("sum_cents"),
        F.greatest("old.max_cents", "more.max_cents").alias("max_cents"),
        F.least("old.min_cents", "more.min_cents").alias("min_cents"),
        (F.coalesce(lost, F.lit(False)) & ~F.coalesce(regained, F.lit(False))).alias("again"),
    )
    gone = merged.filter("readings = 0").select(*GROUP)
    left = merged.filter("readings > 0")
    again = left.filter("again").select(*GROUP)
    computed = M.kpi_partials(silver.join(again, GROUP, "left_semi"))
    return left.filter("not again").drop("again").unionByName(computed), gone


def replace_groups(old: DataFrame, new: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``old`` with the groups of ``new`` in place of theirs and without those that are gone."""
    dropped = new.select(*keys).unionByName(gone.select(*keys))
    return old.join(dropped, list(keys), "left_anti").unionByName(new.select(old.columns))


# --- fingerprints -------------------------------------------------------------------------


def fingerprints(rows: DataFrame, by: str) -> DataFrame:
    """(by, n, sum_a, sum_b): rows and two sums of their hashes per partition, in any order.

    Sums are exact decimals, so fingerprints of disjoint sets of rows add up and can be taken off.
    """
    columns = sorted(rows.columns)
    number = lambda salt: F.sum(F.xxhash64(F.lit(salt), *columns).cast("decimal(38,0)"))
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), number(1).alias("sum_a"), number(2).alias("sum_b"))


def add_up(parts: Sequence[tuple[int, DataFrame]], by: str) -> DataFrame:
    """Sum of fingerprints with signs; partitions without anything left are dropped."""
    signed = None
    for sign, part in parts:
        own = part.select(by, *[(F.col(c) * sign).cast("decimal(38,0)").alias(c) for c in ("n", "sum_a", "sum_b")])
        signed = own if signed is None else signed.unionByName(own)
    total = signed.groupBy(by).agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("n", "sum_a", "sum_b")])
    return total.filter("n <> 0 OR sum_a <> 0 OR sum_b <> 0")


def differing(one: DataFrame, other: DataFrame, by: str) -> DataFrame:
    """Partitions whose fingerprints are not equal, or which only one side has."""
    return add_up([(1, one), (-1, other)], by).select(by)


# --- checks -------------------------------------------------------------------------------

ROWS = 0


def check_states(rows: DataFrame, checks: Sequence[Q.Check], by: str) -> DataFrame:
    """(by, check_no, unexpected): violations per partition; check 0 counts the rows.

    Violations of a uniqueness check add up if a key lies in one partition, that is if ``by`` is
    among its columns.
    """
    counts = [F.struct(F.lit(ROWS).alias("check_no"), F.count(F.lit(1)).alias("unexpected"))]
    apart = []
    for number, check in enumerate(checks, start=1):
        predicate = Q.violation(rows, check)
        if predicate is not None:
            counts.append(F.struct(F.lit(number).alias("check_no"), F.count_if(predicate).alias("unexpected")))
        elif check.kind == "expect_compound_columns_to_be_unique":
            if by not in check.columns:
                raise ValueError(f"{by} is no column of the unique key {check.column}")
            repeated = Q.repeated_rows(rows, check).groupBy(by).agg(F.sum("_n").alias("unexpected"))
            apart.append(repeated.select(by, F.lit(number).alias("check_no"), "unexpected"))
    states = rows.groupBy(by).agg(F.array(*counts).alias("counts")).select(by, F.inline("counts"))
    for part in apart:
        states = states.unionByName(part)
    return states


def report_of_states(states: DataFrame, rows: DataFrame, checks: Sequence[Q.Check]) -> DataFrame:
    """The report ``quality.evaluate`` gives, from stored states; of ``rows`` only the schema is used."""
    totals = {r["check_no"]: r["n"] for r in states.groupBy("check_no").agg(F.sum("unexpected").alias("n")).collect()}
    return Q.report_of_counts(rows, checks, totals)


# --- sketches -----------------------------------------------------------------------------


def key_sketches(rows: DataFrame, by: Column, key: str = M.BUSINESS_KEY, lg_size: int = 12) -> DataFrame:
    """(part, sketch): a sketch of the distinct keys of each partition, some kilobytes whatever its size."""
    return rows.groupBy(by.alias("part")).agg(F.hll_sketch_agg(key, lg_size).alias("sketch"))


def distinct_of(sketches: DataFrame, into: Column) -> DataFrame:
    """(part, distinct_keys): estimates for ranges of partitions, by merging their sketches."""
    merged = sketches.groupBy(into.alias("part")).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("part", F.hll_sketch_estimate("sketch").alias("distinct_keys"))
