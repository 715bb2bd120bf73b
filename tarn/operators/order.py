"""Sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.plans.columns import as_list, top


def sort_values(df: DataFrame, cols: str | list[str]) -> DataFrame:
    """Ascending sort that keeps duplicates, over range partitions.

    Ties are ordered by their place in the input. That keeps the sort stable,
    and lets a value held by a third of all rows be split over many
    partitions; by value alone its rows would all land in one.
    """
    return df.orderBy(*[top(c).asc() for c in as_list(cols)], F.monotonically_increasing_id())


def sort_arrays(df: DataFrame, col: str) -> DataFrame:
    """Sort the list held by each row, ascending, keeping duplicates."""
    return df.withColumn(col, F.array_sort(top(col)))
