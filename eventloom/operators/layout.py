"""How rows spread over partitions, and what a plan holds in memory."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_in_place(df: DataFrame) -> DataFrame:
    """Rows per partition of the plan as it stands; empty partitions have no row."""
    return (
        df.select(F.spark_partition_id().alias("partition_id"))
        .groupBy("partition_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def balance(parts: DataFrame, partitions: int) -> DataFrame:
    """One row: rows in all, in the fullest partition, and times the even share."""
    total = F.sum("rows")
    return parts.agg(
        total.alias("rows"),
        F.count(F.lit(1)).alias("used_partitions"),
        F.max("rows").alias("fullest"),
        F.round(F.max("rows") * F.lit(float(partitions)) / total, 2).alias("times_even"),
    )


@contextmanager
def kept(df: DataFrame, *, fill: bool = True) -> Iterator[DataFrame]:
    """Keep a table in memory, spilling to disk, for the length of a block.

    Project and aggregate first: a kept table holds every column it has. Lost
    pieces are computed again from the sources.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if fill:
            held.count()
        yield held
    finally:
        held.unpersist()


@contextmanager
def job_label(df: DataFrame, text: str) -> Iterator[None]:
    """Name the jobs of a block in Spark's listings and logs."""
    context = df.sparkSession.sparkContext
    context.setJobDescription(text)
    try:
        yield
    finally:
        context.setJobDescription(None)
