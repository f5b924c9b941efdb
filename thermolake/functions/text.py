"""Text columns: strip, sentences, tokens, fingerprints.

The patterns carry ``(?U)`` because Java's ``\\s`` is ASCII-only without it, and name the four
separators U+001C..U+001F that Python counts as white space and Java does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\s\x1c-\x1f]"

# The Unicode White_Space characters, and the four separators Python adds to them.
WHITE_CHARACTERS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
SEPARATORS = "\x1c\x1d\x1e\x1f"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of any kind (plain ``trim`` removes spaces only)."""
    return F.trim(text, F.lit(WHITE_CHARACTERS + SEPARATORS))


def sentences(text: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` where white space follows."""
    return F.split(strip(text), rf"(?U)(?<=[.!?]){WHITE}+")


def tokens(text: Column) -> Column:
    """Lower-cased white-space tokens; punctuation stays, nothing is stemmed."""
    return F.filter(F.split(F.lower(text), rf"(?U){WHITE}+"), lambda t: t != "")


def explode_terms(rows: DataFrame, token_column: str, *keep: str) -> DataFrame:
    """``(*keep, term, tf)`` per distinct token of each row.

    Sorting the row's own tokens and measuring run lengths needs no shuffle, unlike
    ``explode`` + ``groupBy(row, term)``. The steps are columns because a lambda re-evaluates
    whatever expression it mentions for every element.
    """
    ordered, starts = F.col("_ordered"), F.col("_starts")
    first_of_run = F.transform(
        ordered, lambda t, i: F.when((i == 0) | (t != F.get(ordered, i - 1)), i)
    )
    runs = F.transform(
        starts,
        lambda start, j: F.struct(
            F.get(ordered, start).alias("term"),
            (F.coalesce(F.get(starts, j + 1), F.col("_size")) - start).alias("tf"),
        ),
    )
    return (
        rows.withColumn("_ordered", F.array_sort(token_column))
        .withColumns({"_starts": F.array_compact(first_of_run), "_size": F.size("_ordered")})
        .select(*keep, F.inline(runs))
    )


def fingerprint(text: Column) -> Column:
    """Lower-case, runs of non-word characters to one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))


def required(value: Column, name: str) -> Column:
    """The value; a null fails the job with the column's name."""
    return F.when(value.isNull(), F.raise_error(f"{name} is null")).otherwise(value)
