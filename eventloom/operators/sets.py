"""Distinct values, and values a table should or should not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Each value of a column once, null included."""
    return df.select(column).distinct()


def shared_values(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Values found in both tables; each side shrinks to its values before they meet."""
    return a.select(column).distinct().intersect(b.select(column).distinct())


def unknown_values(df: DataFrame, allowed: DataFrame, column: str) -> DataFrame:
    """Values of a column that the allowed list does not hold."""
    return df.select(column).distinct().subtract(allowed.select(column).distinct())


def rows_outside(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows per value that is not in a short list of allowed ones."""
    odd = ~F.coalesce(F.col(column).isin(allowed), F.lit(False))
    return df.where(odd).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
