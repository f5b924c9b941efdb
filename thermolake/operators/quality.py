"""Declarative quality checks evaluated as one aggregation, and the gate built on them.

Checks are data. All value checks of a suite are compiled into a single ``agg``; uniqueness needs
a group-by of its own. Structure checks (columns, types) are answered from the schema.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake import settings
from thermolake.functions.numbers import ratio_4dp
from thermolake.operators.topk import top_k

REPORT_DDL = (
    "check_no int, expectation string, column string, success boolean, observed_value string, "
    "unexpected_count bigint"
)
SAMPLE_SIZE = 20


class QualityGateFailed(RuntimeError):
    """At least one check of the suite failed."""


@dataclass(frozen=True)
class Check:
    """One expectation: ``kind`` is its public name, ``columns`` what it is about."""

    kind: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    or_equal: bool = False

    @property
    def column(self) -> str | None:
        return ",".join(self.columns) or None


def columns_match(*columns: str) -> Check:
    return Check("expect_table_columns_to_match_set", values=columns)


def row_count_between(low: int, high: int | None = None) -> Check:
    return Check("expect_table_row_count_to_be_between", low=low, high=high)


def not_null(column: str) -> Check:
    return Check("expect_column_values_to_not_be_null", (column,))


def in_set(column: str, values: Sequence) -> Check:
    return Check("expect_column_values_to_be_in_set", (column,), values=tuple(values))


def of_type(column: str, type_name: str) -> Check:
    return Check("expect_column_values_to_be_of_type", (column,), values=(type_name,))


def unique_together(*columns: str) -> Check:
    return Check("expect_compound_columns_to_be_unique", columns)


def between(column: str, low: float, high: float | None = None) -> Check:
    """Inclusive; without an upper bound any larger value holds."""
    return Check("expect_column_values_to_be_between", (column,), low=low, high=high)


def greater_than(a: str, b: str, or_equal: bool = False) -> Check:
    return Check("expect_column_pair_values_A_to_be_greater_than_B", (a, b), or_equal=or_equal)


def gold_suite(
    machines: Sequence[str] = settings.MACHINES,
    max_anomaly_rate: float = settings.MAX_ANOMALY_RATE,
    max_rows: int | None = None,
    max_readings: int | None = None,
) -> list[Check]:
    """The fourteen expectations on the daily KPI table.

    Bounds on volume belong to the caller's data; there is none by default.
    """
    # The expectations, their order and the temperature range.
    return [
        columns_match(
            "machine_id", "reading_date", "readings", "anomaly_count", "avg_temperature_c",
            "max_temperature_c", "min_temperature_c", "anomaly_rate", "temp_spread_c",
        ),
        row_count_between(1, max_rows),
        not_null("machine_id"),
        not_null("reading_date"),
        not_null("readings"),
        not_null("anomaly_rate"),
        in_set("machine_id", machines),
        of_type("readings", "int64"),
        unique_together("machine_id", "reading_date"),
        between("readings", 1, max_readings),
        between("anomaly_count", 0, max_readings),
        between("avg_temperature_c", -50.0, 200.0),
        greater_than("max_temperature_c", "min_temperature_c", or_equal=True),
        between("anomaly_rate", 0.0, max_anomaly_rate),
    ]


# Names of the column types a check may ask for.
TYPE_NAMES = {
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "bool": T.BooleanType(),
    "str": T.StringType(),
}


def _missing(rows: DataFrame, column: str) -> Column:
    """Null, or NaN where the type has one."""
    c = F.col(column)
    if isinstance(rows.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _inside(value: Column, check: Check) -> Column:
    return value >= check.low if check.high is None else value.between(check.low, check.high)


def violation(rows: DataFrame, check: Check) -> Column | None:
    """Row predicate (never null) of a row-level check; null for table-level ones.

    Nulls are skipped by value checks; a pair is skipped only when both sides are null.
    """
    kind = check.kind
    if kind == "expect_column_values_to_not_be_null":
        return _missing(rows, check.columns[0])
    if kind == "expect_column_values_to_be_in_set":
        c = F.col(check.columns[0])
        return ~_missing(rows, check.columns[0]) & ~c.isin(list(check.values))
    if kind == "expect_column_values_to_be_between":
        c = F.col(check.columns[0])
        return ~_missing(rows, check.columns[0]) & ~_inside(c, check)
    if kind == "expect_column_pair_values_A_to_be_greater_than_B":
        a, b = check.columns
        no_a, no_b = _missing(rows, a), _missing(rows, b)
        holds = F.col(a) >= F.col(b) if check.or_equal else F.col(a) > F.col(b)
        return ~(no_a & no_b) & (no_a | no_b | ~holds)
    return None


def _row(number: int, check: Check, success: Column, observed: Column, unexpected: Column) -> Column:
    return F.struct(
        F.lit(number).alias("check_no"),
        F.lit(check.kind).alias("expectation"),
        F.lit(check.column).cast("string").alias("column"),
        success.alias("success"),
        observed.cast("string").alias("observed_value"),
        unexpected.cast("bigint").alias("unexpected_count"),
    )


def evaluate(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One report row per check (``REPORT_DDL``), still lazy.

    However many checks there are, the rows are scanned once, plus once per uniqueness check,
    whose counts are combined before the shuffle.
    """
    nothing = F.lit(None)
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    results, unique_reports = [], []
    for number, check in enumerate(checks, start=1):
        predicate = violation(rows, check)
        if predicate is not None:
            name = f"_v{number}"
            aggregates.append(F.count_if(predicate).alias(name))
            results.append(_row(number, check, F.col(name) == 0, nothing, F.col(name)))
        elif check.kind == "expect_table_row_count_to_be_between":
            inside = _inside(F.col("_rows"), check)
            results.append(_row(number, check, inside, F.col("_rows"), nothing))
        elif check.kind == "expect_table_columns_to_match_set":
            same = set(rows.columns) == set(check.values) and len(rows.columns) == len(check.values)
            results.append(
                _row(number, check, F.lit(same), F.lit(",".join(sorted(rows.columns))), nothing)
            )
        elif check.kind == "expect_column_values_to_be_of_type":
            actual = rows.schema[check.columns[0]].dataType
            label = next((n for n, t in TYPE_NAMES.items() if t == actual), actual.simpleString())
            results.append(
                _row(number, check, F.lit(label == check.values[0]), F.lit(label), nothing)
            )
        elif check.kind == "expect_compound_columns_to_be_unique":
            total = F.coalesce(F.sum("_n"), F.lit(0)).alias("_dup")
            repeated = repeated_rows(rows, check).agg(total)
            report = _row(number, check, F.col("_dup") == 0, nothing, F.col("_dup"))
            unique_reports.append(repeated.select(F.inline(F.array(report))))
        else:
            raise ValueError(f"unknown expectation {check.kind!r}")
    report = rows.agg(*aggregates).select(F.inline(F.array(*results)))
    for extra in unique_reports:
        report = report.unionByName(extra)
    return report


def repeated_rows(rows: DataFrame, check: Check) -> DataFrame:
    """Keys of a uniqueness check that rows share, with their number ``_n``; keys of nulls only do not count."""
    all_missing = F.lit(True)
    for c in check.columns:
        all_missing &= _missing(rows, c)
    counted = rows.filter(~all_missing).groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n"))
    return counted.filter("_n > 1")


def report_of_counts(rows: DataFrame, checks: Sequence[Check], counts: dict[int, int]) -> DataFrame:
    """The report of ``evaluate`` when the violations of each check are known (0: the rows)."""
    spark, out = rows.sparkSession, []
    for number, check in enumerate(checks, start=1):
        found = counts.get(number, 0)
        if check.kind == "expect_table_row_count_to_be_between":
            total = counts.get(0, 0)
            inside = spark.range(1).select(_inside(F.lit(total), check)).first()[0]
            out.append((number, check.kind, check.column, inside, str(total), None))
        elif check.kind == "expect_table_columns_to_match_set":
            same = set(rows.columns) == set(check.values) and len(rows.columns) == len(check.values)
            out.append((number, check.kind, check.column, same, ",".join(sorted(rows.columns)), None))
        elif check.kind == "expect_column_values_to_be_of_type":
            actual = rows.schema[check.columns[0]].dataType
            label = next((n for n, t in TYPE_NAMES.items() if t == actual), actual.simpleString())
            out.append((number, check.kind, check.column, label == check.values[0], label, None))
        else:
            out.append((number, check.kind, check.column, found == 0, None, found))
    return spark.createDataFrame(out, REPORT_DDL)


def summarise(
    report: DataFrame,
    rows: DataFrame,
    checks: Sequence[Check],
    rate_column: str = "anomaly_rate",
) -> DataFrame:
    """One row: success, counts, success percent (two decimals), rows, allowed and observed rate."""
    ceilings = [c.high for c in checks if c.columns == (rate_column,) and c.high is not None]
    observed = rows.agg(
        F.count(F.lit(1)).alias("gold_rows"), F.max(rate_column).alias("observed_max_anomaly_rate")
    )
    totals = report.agg(
        F.count(F.lit(1)).alias("expectations_evaluated"),
        F.count_if("success").alias("expectations_passed"),
    )
    evaluated, passed = F.col("expectations_evaluated"), F.col("expectations_passed")
    # Two frames of one row each.
    return totals.join(F.broadcast(observed)).select(
        (evaluated == passed).alias("success"),
        "expectations_evaluated",
        "expectations_passed",
        (evaluated - passed).alias("expectations_failed"),
        # A ratio with four decimals is a percentage with two.
        F.round(ratio_4dp(passed, evaluated) * 100, 2).alias("success_percent"),
        "gold_rows",
        F.lit(ceilings[0] if ceilings else None).cast("double").alias("max_anomaly_rate_allowed"),
        "observed_max_anomaly_rate",
    )


def failure_sample(rows: DataFrame, check: Check, order: Sequence[str], size: int = SAMPLE_SIZE) -> DataFrame:
    """First ``size`` violating rows in the given order, restricted to the check's columns."""
    predicate = violation(rows, check)
    if predicate is None:
        if check.kind != "expect_compound_columns_to_be_unique":
            return rows.select(*check.columns).limit(0)
        repeated = rows.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        return repeated.drop("_n").orderBy(*check.columns).limit(size)
    return rows.filter(predicate).orderBy(*order).select(*check.columns).limit(size)


def failure_samples(
    rows: DataFrame, checks: Sequence[Check], numbers: Sequence[int], order: Sequence[str], size: int = SAMPLE_SIZE
) -> DataFrame:
    """(check_no, rank, value): first ``size`` violating rows of the checks with these numbers.

    All row-level checks share one scan: a row stands for every check it breaks, and a task sends on at
    most ``size`` rows per check. Uniqueness checks count their keys on their own.
    """
    broken, repeated = [], []
    value = lambda check: F.array(*[F.col(c).cast("string") for c in check.columns])
    for number in numbers:
        check = checks[number - 1]
        predicate = violation(rows, check)
        if predicate is not None:
            broken.append(F.when(predicate, F.struct(F.lit(number).alias("check_no"), value(check).alias("value"))))
        elif check.kind == "expect_compound_columns_to_be_unique":
            keys = repeated_rows(rows, check).select(F.lit(number).alias("check_no"), value(check).alias("value"), *check.columns)
            best = keys.orderBy(*check.columns).limit(size)
            repeated.append(top_k(best, ["check_no"], [F.asc(c) for c in check.columns], size).select("check_no", "rank", "value"))
    parts = list(repeated)
    if broken:
        found = rows.select(*order, F.explode(F.array_compact(F.array(*broken))).alias("_broken")).select(*order, "_broken.*")
        parts.append(top_k(found, ["check_no"], [F.asc(c) for c in order], size).select("check_no", "rank", "value"))
    if not parts:
        return rows.sparkSession.createDataFrame([], "check_no int, rank int, value array<string>")
    return reduce(DataFrame.unionByName, parts)


def quarantine(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add ``violations``: the labels of the row-level and uniqueness checks a row breaks."""
    labels = []
    flagged = rows
    for check in checks:
        predicate = violation(rows, check)
        if predicate is None and check.kind == "expect_compound_columns_to_be_unique":
            # A join against the repeated keys, not a window: no hot key has to fit in one task.
            repeated = rows.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n"))
            mark = f"_repeated{len(labels)}"
            keys = repeated.filter("_n > 1").select(*check.columns, F.lit(True).alias(mark))
            flagged = flagged.join(keys, list(check.columns), "left")
            predicate = F.col(mark).isNotNull()
        if predicate is not None:
            label = f"{check.kind}({check.column})"
            labels.append(F.when(predicate, F.lit(label)))
    return flagged.withColumn("violations", F.array_compact(F.array(*labels))).select(
        *rows.columns, "violations"
    )


def run_gate(
    gold: DataFrame,
    checks: Sequence[Check],
    evidence: str | None = None,
    rate_column: str = "anomaly_rate",
    order: Sequence[str] = ("machine_id", "reading_date"),
) -> dict:
    """Evaluate, write the evidence, then raise ``QualityGateFailed`` if anything failed.

    Samples are fetched only for failed checks, all at once. The report has one row per check, so it
    may be collected.
    """
    report = evaluate(gold, checks).orderBy("check_no").collect()
    failed = [r for r in report if not r["success"]]
    observed = gold.agg(F.count(F.lit(1)).alias("n"), F.max(rate_column).alias("m")).first()
    ceilings = [c.high for c in checks if c.columns == (rate_column,) and c.high is not None]
    evaluated = len(report)
    samples: dict[int, list[list]] = {r["check_no"]: [] for r in failed}
    asked = [r["check_no"] for r in failed if r["column"]]
    for s in failure_samples(gold, checks, asked, order).orderBy("check_no", "rank").collect() if asked else ():
        samples[s["check_no"]].append(s["value"])
    # The names of the evidence.
    summary = {
        "success": not failed,
        "expectations_evaluated": evaluated,
        "expectations_passed": evaluated - len(failed),
        "expectations_failed": len(failed),
        "success_percent": round(100.0 * (evaluated - len(failed)) / evaluated, 2),
        "gold_rows": observed["n"],
        "max_anomaly_rate_allowed": ceilings[0] if ceilings else None,
        "observed_max_anomaly_rate": observed["m"],
        "failed_expectations": [
            {
                "expectation": r["expectation"],
                "column": r["column"],
                "observed_value": r["observed_value"],
                "unexpected_count": r["unexpected_count"],
                "partial_unexpected_list": [v[0] or "None" if len(v) == 1 else str(tuple(v)) for v in samples[r["check_no"]]],
            }
            for r in failed
        ],
    }
    if evidence is not None:
        spark = gold.sparkSession
        ddl = (
            "success boolean, expectations_evaluated int, expectations_passed int, "
            "expectations_failed int, success_percent double, gold_rows bigint, "
            "max_anomaly_rate_allowed double, observed_max_anomaly_rate double, "
            "failed_expectations array<struct<expectation:string,column:string,"
            "observed_value:string,unexpected_count:bigint,partial_unexpected_list:array<string>>>"
        )
        rows = spark.createDataFrame([summary], ddl).withColumn("checked_at", F.current_timestamp())
        rows.coalesce(1).write.mode("overwrite").json(evidence)
    if failed:
        raise QualityGateFailed(
            f"{len(failed)} of {evaluated} expectations did not pass "
            f"(observed {rate_column} {observed['m']}, allowed {summary['max_anomaly_rate_allowed']})"
        )
    return summary
