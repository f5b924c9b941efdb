"""Exact two- and four-decimal arithmetic on integers, and number formatting.

Sums of integer cents do not depend on the order in which tasks finish, and the rounding of a
quotient is decided by integer division instead of by the last bit of a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(value: Column) -> Column:
    """Hundredths of a value that already has at most two decimals, as BIGINT."""
    return F.round(value * 100).cast("bigint")


def from_cents(value: Column) -> Column:
    return value / F.lit(100.0)


def divide_half_up(numerator: Column, denominator: Column) -> Column:
    """Integer quotient rounded half away from zero; the denominator must be positive."""
    magnitude = F.call_function(
        "div", F.abs(numerator) * 2 + denominator, denominator * 2
    )
    return F.when(numerator < 0, -magnitude).otherwise(magnitude)


def mean_2dp(sum_of_cents: Column, count: Column) -> Column:
    return divide_half_up(sum_of_cents, count) / F.lit(100.0)


def ratio_4dp(part: Column, whole: Column) -> Column:
    return divide_half_up(part * 10000, whole) / F.lit(10000.0)


def float_text(value: Column) -> Column:
    """The shortest decimal text, plain between 1e-4 and 1e16 and with an exponent outside.

    A Spark cast already switches to an exponent below 1e-3 and from 1e7 on.
    """
    text = value.cast("string")
    size = F.abs(value)
    plain = F.regexp_replace(
        F.when((size >= 1e-4) & (size < 1e16), text).cast("decimal(38,20)").cast("string"),
        r"(\.\d+?)0+$",
        "$1",
    )
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1)
    digits = F.regexp_replace(exponent, "-", "")
    scientific = F.concat(
        mantissa,
        F.when(exponent.startswith("-"), "e-").otherwise("e+"),
        F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits),
    )
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )
