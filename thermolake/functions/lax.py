"""Lax coercion of JSON values held as VARIANT.

``from_json`` with a typed schema turns ``"70.5"`` into null and the number 5 into ``'5'``, and a
plain cast reads ``'12d'`` as 12.0. So each field is judged by its JSON kind first
(``schema_of_variant``) and text is guarded by a pattern before it is cast.

Each function takes a DataFrame holding ``_raw_<field>`` (VARIANT) and ``_kind_<field>``, and
returns it with the typed ``<field>`` (null when unusable), together with the expression of the
error text. The text is an expression, not a column, so only failing rows pay for it; intermediate
results are columns, so each pattern runs once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake.functions.text import WHITE_CHARACTERS

# Error texts, as the public validation library words them.
MISSING = "Field required"
EXTRA = "Extra inputs are not permitted"
NOT_STRING = "Input should be a valid string"
TOO_SHORT = "String should have at least 1 character"
NOT_NUMBER = "Input should be a valid number"
BAD_NUMBER_TEXT = "Input should be a valid number, unable to parse string as a number"
NOT_DATETIME = "Input should be a valid datetime"
BAD_DATETIME_TEXT = "Input should be a valid datetime or date"
INPUT_SHORT = "input is too short"
BAD_YEAR = "invalid character in year"
BAD_MONTH = "invalid character in month"
BAD_DAY = "invalid character in day"
BAD_SEPARATOR = "invalid date separator, expected `-`"
MONTH_RANGE = "month value is outside expected range of 1-12"
DAY_RANGE = "day value is outside expected range"
YEAR_ZERO = "year 0 is out of range"
TRAILING = "unexpected extra characters at the end of the input"
EPOCH_HIGH = "dates after 9999 are not supported as unix timestamps"
EPOCH_LOW = "dates before 0000 are not supported as unix timestamps"

# Unix numbers above this size are milliseconds; first and last second of the
# supported calendar.
EPOCH_WATERSHED = 20_000_000_000
EPOCH_MIN_S = -62_135_596_800
EPOCH_MAX_S = 253_402_300_799

NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
SPECIAL_NUMBER_TEXT = r"(?i)^[+-]?(nan|inf|infinity)$"
EPOCH_TEXT = r"^[+-]?\d+(\.\d+)?$"
DATE_TEXT = r"^(\d{4}-\d{2}-\d{2})"
TIME_TEXT = r"([01]\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?"
ZONE_TEXT = r"([zZ]|[+\-−]([01]\d|2[0-3]):?[0-5]\d)?"
DATETIME_TEXT = rf"{DATE_TEXT}([Tt _]({TIME_TEXT}){ZONE_TEXT})?$"



def strip_white(text: Column) -> Column:
    """Strip Unicode white space, which is what the contract's string fields do."""
    return F.trim(text, F.lit(WHITE_CHARACTERS))


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _with_text(df: DataFrame, name: str) -> DataFrame:
    text = F.when(F.col(f"_kind_{name}") == "STRING", F.try_variant_get(f"_raw_{name}", "$", "string"))
    return df.withColumn(f"_text_{name}", text)


def lax_string(df: DataFrame, name: str, min_length: int = 0) -> tuple[DataFrame, Column]:
    kind, stripped = F.col(f"_kind_{name}"), strip_white(F.col(f"_text_{name}"))
    error = (
        F.when(kind.isNull(), MISSING).when(kind != "STRING", NOT_STRING).otherwise(TOO_SHORT)
    )
    typed = _with_text(df, name).withColumn(name, stripped)
    if min_length:
        typed = typed.withColumn(name, F.when(F.length(name) >= min_length, F.col(name)))
    return typed, error


def non_empty_string(df: DataFrame, name: str) -> tuple[DataFrame, Column]:
    return lax_string(df, name, min_length=1)


def lax_double(df: DataFrame, name: str) -> tuple[DataFrame, Column]:
    raw, kind, text = F.col(f"_raw_{name}"), F.col(f"_kind_{name}"), F.col(f"_text_{name}")
    # One underscore between two characters is a digit separator.
    digits = F.when(~text.rlike("^_|_$|__"), F.regexp_replace(text, "_", ""))
    special = (
        F.when(F.lower(text).contains("nan"), float("nan"))
        .when(text.startswith("-"), float("-inf"))
        .otherwise(float("inf"))
    )
    number = (
        F.when(_is_number(kind), F.try_variant_get(raw, "$", "double"))
        .when(kind == "BOOLEAN", F.try_variant_get(raw, "$", "boolean").cast("int").cast("double"))
        .when(text.rlike(SPECIAL_NUMBER_TEXT), special)
        .when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    )
    error = (
        F.when(kind.isNull(), MISSING).when(kind == "STRING", BAD_NUMBER_TEXT).otherwise(NOT_NUMBER)
    )
    typed = (
        _with_text(df, name)
        .withColumn(f"_text_{name}", strip_white(text))
        .withColumn(f"_text_{name}", digits)
        .withColumn(name, number)
    )
    return typed, error


def _date_problem(text: Column) -> Column:
    """Why a text that is not a timestamp is not one; evaluated on failing rows only."""
    month = F.substring(text, 6, 2).try_cast("int")
    day = F.substring(text, 1, 10).try_cast("date")
    detail = (
        F.when(F.length(text) < 10, INPUT_SHORT)
        .when(~text.rlike(r"^\d{4}"), BAD_YEAR)
        .when(F.substring(text, 5, 1) != "-", BAD_SEPARATOR)
        .when(~text.rlike(r"^.{5}\d{2}"), BAD_MONTH)
        .when(F.substring(text, 8, 1) != "-", BAD_SEPARATOR)
        .when(~text.rlike(r"^.{8}\d{2}"), BAD_DAY)
        .when(~month.between(1, 12), MONTH_RANGE)
        .when(~text.startswith("0000") & day.isNull(), DAY_RANGE)
        .otherwise(TRAILING)
    )
    return F.when(
        text.startswith("0000") & text.rlike(DATETIME_TEXT),
        F.lit(f"{NOT_DATETIME}, {YEAR_ZERO}"),
    ).otherwise(F.concat(F.lit(f"{BAD_DATETIME_TEXT}, "), detail))


def lax_timestamp(df: DataFrame, name: str) -> tuple[DataFrame, Column]:
    """ISO text (offset-less means the session zone, UTC), date, or unix number."""
    raw, kind, text = F.col(f"_raw_{name}"), F.col(f"_kind_{name}"), F.col(f"_text_{name}")
    clock, zone, iso = F.col(f"_clock_{name}"), F.col(f"_zone_{name}"), F.col(f"_iso_{name}")
    number, seconds = F.col(f"_number_{name}"), F.col(f"_seconds_{name}")
    is_number = _is_number(kind)
    is_epoch_text = text.rlike(EPOCH_TEXT)

    # ISO text: after the one pattern match the parts sit at known places.
    matched = F.when(text.rlike(DATETIME_TEXT) & ~text.startswith("0000"), text)
    time_part = F.translate(F.substring(iso, 12, 64), "−,", "-.")
    sign_at = F.greatest(F.instr(time_part, "+"), F.instr(time_part, "-"))
    zone_part = F.when(sign_at > 0, F.substring(time_part, sign_at, F.lit(6)))
    clock_part = F.rtrim(
        F.when(sign_at > 0, F.substring(time_part, F.lit(1), sign_at - 1)).otherwise(time_part),
        F.lit("zZ"),
    )
    # Digits beyond the microsecond are cut, not rounded.
    stamp = F.concat(
        F.substring(iso, 1, 10),
        F.lit(" "),
        F.when(F.length(clock) == 0, "00:00:00")
        .when(F.length(clock) == 5, F.concat(clock, F.lit(":00")))
        .otherwise(F.substring(clock, 1, 15)),
        F.lit("Z"),
    ).try_cast("timestamp")
    # Offsets reach +-23:59, more than a Spark zone offset may hold, so they are subtracted.
    minutes = F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, -2, 2).cast("int")
    shift = F.when(zone.isNull(), 0).when(zone.startswith("-"), -minutes).otherwise(minutes)
    from_text = F.timestamp_micros(F.unix_micros(stamp) - shift.cast("bigint") * 60_000_000)

    epoch = F.when(is_number, F.try_variant_get(raw, "$", "decimal(38,6)")).when(
        is_epoch_text, text.try_cast("decimal(38,6)")
    )
    in_seconds = F.when(F.abs(number) > EPOCH_WATERSHED, number / 1000).otherwise(number)
    in_calendar = (seconds >= EPOCH_MIN_S) & (F.floor(seconds) <= EPOCH_MAX_S)
    from_epoch = F.timestamp_micros(
        F.when(in_calendar, F.round(seconds * 1_000_000).cast("bigint"))
    )

    too_far = F.concat(
        F.when(is_number, NOT_DATETIME).otherwise(BAD_DATETIME_TEXT),
        F.lit(", "),
        F.when(seconds < EPOCH_MIN_S, EPOCH_LOW).otherwise(EPOCH_HIGH),
    )
    problem = (
        F.when(kind.isNull(), MISSING)
        .when(is_number | is_epoch_text, too_far)
        .when(kind == "STRING", _date_problem(text))
        .otherwise(NOT_DATETIME)
    )
    typed = (
        _with_text(df, name)
        .withColumn(f"_iso_{name}", matched)
        .withColumns({f"_clock_{name}": clock_part, f"_zone_{name}": zone_part})
        .withColumn(f"_number_{name}", F.when(iso.isNull(), epoch))
        .withColumn(f"_seconds_{name}", in_seconds)
        .withColumn(name, F.when(iso.isNotNull(), from_text).otherwise(from_epoch))
    )
    return typed, problem
