"""Ranking helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows per key with a 1-based ``rank``.

    Catalyst puts a window group limit in front of the shuffle, so a map task sends at most ``k``
    rows per key however hot the key is.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
