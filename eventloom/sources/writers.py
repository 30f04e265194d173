"""Parquet writers that control how many files there are and what each holds."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.sizing import files_for
from eventloom.sources.scratch import scratch_path

#: Rows written to learn the stored bytes of a row.
SAMPLE_ROWS = 1_000_000

_GLOB = re.compile(r"[*?\[{]")


def _plain(path: str) -> str:
    """A path without local-file scheme, doubled or trailing slashes."""
    path = re.sub(r"^file:/+", "/", path)
    scheme, sep, rest = path.partition("://")
    if sep:
        return f"{scheme}://{re.sub('/+', '/', rest).rstrip('/')}"
    return re.sub("/+", "/", path).rstrip("/") or "/"


def _fixed_part(path: str) -> str:
    """The folder above the first wildcard, or the whole path without one."""
    hit = _GLOB.search(path)
    return path if hit is None else path[: hit.start()].rpartition("/")[0]


def _inside(path: str, folder: str) -> bool:
    return path == folder or path.startswith(folder.rstrip("/") + "/")


def check_target(target: str, input_roots: Iterable[str]) -> None:
    """Refuse a target that a later read of the inputs would pick up, or that
    would replace an input when overwritten."""
    out = _plain(target)
    for root in input_roots:
        base = _plain(_fixed_part(root))
        if _inside(out, base) or _inside(base, out):
            raise ValueError(f"output {target} and input {root} overlap")


def write_table(
    df: DataFrame,
    target: str,
    *,
    input_roots: Iterable[str] = (),
    overwrite: bool = False,
    compression: str = "snappy",
) -> None:
    """Write as the plan's partitions stand; an existing target is refused by default."""
    check_target(target, input_roots)
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).option("compression", compression).parquet(target)


def write_repartitioned(df: DataFrame, target: str, files: int, **options) -> None:
    """Exactly ``files`` even files (fewer when there are fewer rows); one full shuffle."""
    write_table(df.repartition(files), target, **options)


def write_coalesced(df: DataFrame, target: str, files: int, **options) -> None:
    """At most ``files`` files without a shuffle.

    Only as many tasks as files run the step before the write, so use it after
    a step that shrinks the data, never to squeeze a large scan.
    """
    write_table(df.coalesce(files), target, **options)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path, from the file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength())


def bytes_when_written(df: DataFrame, rows: int = SAMPLE_ROWS) -> int:
    """Stored bytes of a table that is cheap to read twice, from a sample that is written.

    Rows are counted, about ``rows`` of them are written to a scratch folder, and their
    bytes per row are scaled up; a table of fewer rows is written whole.
    """
    n = df.count()
    if not n:
        return 0
    spark, path, seen = df.sparkSession, scratch_path(df.sparkSession, "sized-sample"), Observation()
    some = df if n <= rows else df.sample(rows / n, seed=1)
    some.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return math.ceil(stored_bytes(spark, path) / max(1, seen.get["n"]) * n)


def write_sized(
    df: DataFrame, target: str, *, target_bytes: int = 128 * 1024 * 1024, minimum: int = 1, even: bool = True, **options
) -> int:
    """Files of about ``target_bytes`` that nobody had to guess; returns how many were asked for.

    A derived table's size cannot be known beforehand, so its rows are written
    to a scratch folder first, the bytes there name the number of files, and the files
    are made from that copy: the plan runs once. ``even`` files take a shuffle of the copy,
    otherwise its pieces are put together as they lie.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "sized")
    df.write.parquet(path)
    files = files_for(stored_bytes(spark, path), target_bytes, minimum)
    held = spark.read.schema(df.schema).parquet(path)
    (write_repartitioned if even else write_coalesced)(held, target, files, **options)
    return files


def write_ordered(
    df: DataFrame,
    target: str,
    files: int,
    order_by: Sequence[str],
    *,
    place: Sequence[str] = (),
    **options,
) -> None:
    """``files`` files that each hold one range of ``order_by``, sorted inside.

    ``place`` names columns that are not written but tell equal rows apart, so
    that even copies of one row can be cut into several files.
    """
    ties = ["place_hash"] if place else []
    # only the hash of the place travels through the shuffle
    rows = df.withColumn("place_hash", F.xxhash64(*place)).drop(*place) if place else df
    ranged = rows.repartitionByRange(files, *order_by, *ties).sortWithinPartitions(*order_by)
    write_table(ranged.drop(*ties), target, **options)
