"""Parquet readers for single roots, several versions and single part files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_root(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """One Parquet root; with a schema no footer is read before the job starts."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root)


def read_merged(spark: SparkSession, *roots: str) -> DataFrame:
    """Several roots or globs as one table with the union of their columns.

    Reads every footer (in a Spark job) and fails when one column has two
    types. Prefer ``read_versions`` when each root holds a single version.
    """
    return spark.read.option("mergeSchema", "true").parquet(*roots)


def read_unmerged(spark: SparkSession, *roots: str) -> DataFrame:
    """Several roots or globs under the first file's schema; later columns are lost.

    Kept to show what a plain read of grown data misses, not for analysis.
    """
    return spark.read.option("mergeSchema", "false").parquet(*roots)


def union_versions(versions: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column a version lacks is null in its rows.

    A column with two types fails here rather than being widened silently.
    """
    if not versions:
        raise ValueError("no versions given")
    seen: dict[str, str] = {}
    for version in versions:
        for name, kind in version.dtypes:
            if seen.setdefault(name, kind) != kind:
                raise ValueError(f"column {name} is {seen[name]} in one version and {kind} in another")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), versions)


def read_versions(
    spark: SparkSession, roots: Sequence[str], schemas: Sequence[StructType] | None = None
) -> DataFrame:
    """Same rows as ``read_merged`` from one footer per root, or none with schemas."""
    given = schemas if schemas is not None else [None] * len(roots)
    return union_versions([read_root(spark, r, s) for r, s in zip(roots, given, strict=True)])


def read_part(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """The rows of one part file, by its name, or by its path where folders hold equal names;
    the file filter prunes the listing, not the rows."""
    which = "file_path" if "/" in file_name else "file_name"
    return spark.read.parquet(root).where(F.col(f"_metadata.{which}") == file_name)


def nanos_as_time(df: DataFrame, *columns: str) -> DataFrame:
    """Turn nanosecond counts into zoneless timestamps with microseconds.

    Some writers store nanosecond timestamps, which Spark refuses to read
    unless ``spark.sql.legacy.parquet.nanosAsLong`` makes them numbers.
    Columns that already are timestamps stay as they are.
    """
    kinds = dict(df.dtypes)
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def moment(name: str):
        micros = F.floor(F.col(name) / F.lit(1000).cast("decimal(20,0)")).cast("decimal(20,0)")
        seconds = (micros / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
        return start + F.make_dt_interval(secs=seconds)

    return df.withColumns({c: moment(c) for c in columns if kinds[c] == "bigint"})


def with_row_place(df: DataFrame, file_column: str = "file_path", row_column: str = "row_index") -> DataFrame:
    """Add where a row is stored: file and position in it. Only for file reads."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(file_column),
        F.col("_metadata.row_index").alias(row_column),
    )
