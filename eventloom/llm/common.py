"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder, so that lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, label: str) -> str:
    """URI of a new folder in the shared place, for files that tasks write themselves."""
    path = scratch_path(spark, label)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.select(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def tasks_for(spark: SparkSession, size: int, each: int) -> int:
    """Tasks of about ``each`` bytes or rows, at least the session's shuffle width."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each), 1)


#: How to empty what modules keep in a Python worker between tasks.
KEPT_IN_WORKER: list[Callable[[], None]] = []


def release_memory() -> None:
    """Gives back what a reused Python worker still holds from tasks of other operators."""
    for forget in KEPT_IN_WORKER:
        forget()
    trim_memory()


def trimmed(of: Callable, before: Callable[[], None] = release_memory, after: Callable[[], None] = lambda: None) -> Callable:
    """A function for mapInArrow that gives memory back before and after its task: Spark
    deals tasks over all idle workers, and each would keep the peak of its last one."""

    def each(batches):
        before()
        yield from of(batches)
        after()
        trim_memory()

    return each


def trim_memory() -> None:
    """Gives memory that is free in this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
