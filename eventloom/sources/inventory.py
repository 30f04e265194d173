"""File inventories from the file metadata columns of a scan."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_profile(spark: SparkSession, roots: Mapping[str, str], kind: str = "parquet") -> DataFrame:
    """One row per file: root name, path, bytes, rows. Of Parquet files only footers are read."""
    per_root = [
        spark.read.format(kind)
        .load(path)
        .select(
            F.lit(name).alias("root"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_bytes"),
        )
        .groupBy("root", "file_path", "file_bytes")
        .agg(F.count(F.lit(1)).alias("rows"))
        for name, path in roots.items()
    ]
    return reduce(DataFrame.unionByName, per_root)


def root_totals(files: DataFrame) -> DataFrame:
    """Files, bytes and rows per root, and for all roots together as root ``all``."""
    totals = files.rollup("root").agg(
        F.grouping("root").alias("is_total"),
        F.count(F.lit(1)).alias("files"),
        F.sum("file_bytes").alias("bytes"),
        F.sum("rows").alias("rows"),
    )
    return totals.select(
        F.when(F.col("is_total") == 1, F.lit("all")).otherwise(F.col("root")).alias("root"),
        "files",
        "bytes",
        "rows",
    )


def expect_files(totals: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Compare the number of files per root with what was meant to be written."""
    pairs = [F.lit(x) for pair in expected.items() for x in pair]
    wanted = F.try_element_at(F.create_map(*pairs), F.col("root"))
    return totals.withColumn("expected_files", wanted.cast("bigint")).withColumn(
        "files_ok", F.col("files") == F.col("expected_files")
    )
