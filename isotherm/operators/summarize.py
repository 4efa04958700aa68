"""Highest and lowest temperature per date, with the city that had each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
MIN_INT = -2147483648
MAX_INT = 2147483647
# --------------------------------------------------------------------------


def extreme_columns(order: Sequence[str] = ("pos",)) -> list[Column]:
    """Aggregates ``max_temp, max_temp_city, min_temp, min_temp_city``.

    Of equal temperatures the first in file order counts. ``order`` names
    numeric columns that give that order. A date whose temperatures all equal
    the smallest (largest) 32-bit number has no hottest (coldest) city: the
    name stays empty.

    The aggregates combine on the map side, so a date that holds most of the
    rows is reduced to one row per task before it is shuffled.
    """
    known = F.col("temperature").isNotNull()
    backwards = [(-F.col(name)).alias(f"order_{i}") for i, name in enumerate(order)]
    forwards = [F.col(name).alias(f"order_{i}") for i, name in enumerate(order)]
    hottest = F.max(F.when(known, F.struct("temperature", *backwards, "city")))
    coldest = F.min(F.when(known, F.struct("temperature", *forwards, "city")))
    return [
        hottest["temperature"].alias("max_temp"),
        F.when(hottest["temperature"] == MIN_INT, F.lit("")).otherwise(hottest["city"]).alias("max_temp_city"),
        coldest["temperature"].alias("min_temp"),
        F.when(coldest["temperature"] == MAX_INT, F.lit("")).otherwise(coldest["city"]).alias("min_temp_city"),
    ]


def daily_extremes(
    observations: DataFrame, file_columns: Sequence[str] = (), order: Sequence[str] = ("pos",)
) -> DataFrame:
    """One row per file and date. Without ``file_columns`` all rows are one file."""
    return observations.groupBy(*file_columns, "date").agg(*extreme_columns(order))
