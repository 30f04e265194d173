"""Pairs of events that share a skewed key: three ways to one answer.

None of them forms the pairs. One count per key, squared, is enough; the salted
ways shrink the self-join's right side to a count per key, and each left row
adds up the partners it would have met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventloom.operators.joins import (
    counted_side,
    hot_key_join,
    pair_counts,
    salted_join,
    sum_partners,
)


def pairs_salted(df: DataFrame, key: str, spread_by: list[str], buckets: int = 10) -> DataFrame:
    """Rows joined to the partner counts of their key, every key spread over ``buckets`` tasks."""
    left = df.select(key, *[c for c in spread_by if c != key])
    return sum_partners(
        salted_join(left, counted_side(df, key), key, buckets=buckets, spread_by=spread_by), key
    )


def pairs_hot_salted(df: DataFrame, key: str, spread_by: list[str], **options) -> DataFrame:
    """The same with only the hot keys spread, whatever the size of the counts."""
    left = df.select(key, *[c for c in spread_by if c != key])
    return sum_partners(
        hot_key_join(left, counted_side(df, key), key, spread_by=spread_by, **{"max_bytes": 0, **options}), key
    )


def pairs_counted(df: DataFrame, key: str) -> DataFrame:
    """One count per key, squared; the cheapest way."""
    return pair_counts(df, None, key)
