"""Size checks that decide between a broadcast and a shuffle, and file counts.

Estimates only ever choose between plans; files are counted from bytes that have
been written (``sources.writers``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# Parquet bytes after column pruning; several times that once decoded.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _known(df: DataFrame, plan) -> int | None:
    """A plan's size; Catalyst's default stands for a size that is not known."""
    size = int(str(plan.stats().sizeInBytes()))
    return size if size < int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1))) else None


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the pruned plan, or None where it is not known."""
    try:
        return _known(df, df._jdf.queryExecution().optimizedPlan())
    except AttributeError:
        return None


def source_bytes(df: DataFrame) -> int | None:
    """Bytes of all tables a plan reads, or None where one is not known."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    except AttributeError:
        return None
    sizes = [_known(df, leaves.apply(i)) for i in range(leaves.size())]
    return None if None in sizes else sum(sizes)


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True only when the estimate is known and within the bound.

    Catalyst overestimates joins and aggregates, so a derived dimension may be
    refused that would fit; callers always have another way.
    """
    size = estimated_bytes(df)
    return size is not None and size <= max_bytes


def files_for(size: int, target_bytes: int = 128 * 1024 * 1024, minimum: int = 1) -> int:
    """Files that hold ``size`` bytes at about ``target_bytes`` each."""
    return max(minimum, math.ceil(size / target_bytes))
