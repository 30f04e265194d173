"""What each Parquet file holds by itself: its columns, their types and stored bytes.

A table's files need not have one schema, and Spark has no expression for a
footer, so tasks read the footers with pyarrow, each file's last bytes only. Files
are listed by Spark; a store that pyarrow cannot open is read through Spark's
own reader, which takes the files whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.scratch import scratch_path

#: Footers that one task reads.
FILES_PER_TASK = 64
#: Stores whose files pyarrow opens by range.
RANGED = ("", "file", "hdfs", "s3", "gs")
_COLUMNS = "file_path string, file_rows long, column_name string, type string, stored_bytes long, plain_bytes long"


def _described(path: str, footer: pq.ParquetFile) -> Iterator[dict]:
    """One row per top-level column; chunks of nested fields count for their column."""
    stored, plain = {}, {}
    meta = footer.metadata
    for group in range(meta.num_row_groups):
        for i in range(meta.num_columns):
            chunk = meta.row_group(group).column(i)
            name = chunk.path_in_schema.split(".")[0]
            stored[name] = stored.get(name, 0) + chunk.total_compressed_size
            plain[name] = plain.get(name, 0) + chunk.total_uncompressed_size
    for field in footer.schema_arrow:
        yield {
            "file_path": path,
            "file_rows": meta.num_rows,
            "column_name": field.name,
            "type": str(field.type),
            "stored_bytes": stored.get(field.name.split(".")[0], 0),
            "plain_bytes": plain.get(field.name.split(".")[0], 0),
        }


def _opened(path: str, content: bytes | None):
    if content is not None:
        return pa.BufferReader(content)
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return pa.OSFile(unquote(parts.path))
    store, inside = pafs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


_KINDS = pa.schema(
    [
        ("file_path", pa.string()),
        ("file_rows", pa.int64()),
        ("column_name", pa.string()),
        ("type", pa.string()),
        ("stored_bytes", pa.int64()),
        ("plain_bytes", pa.int64()),
    ]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: the columns of each listed file."""
    for batch in batches:
        for row in batch.to_pylist():
            with _opened(row["path"], row.get("content")) as source:
                yield pa.RecordBatch.from_pylist(list(_described(row["path"], pq.ParquetFile(source))), schema=_KINDS)


def column_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per file and column under a root: type, rows of the file, bytes of the column
    as stored and as encoded before compression. Written once, then read."""
    options = {"pathGlobFilter": "*.parquet", "recursiveFileLookup": "true"}
    files = spark.read.format("binaryFile").options(**options).load(root)
    ranged = urlparse(root).scheme in RANGED
    listed = files.select("path", *([] if ranged else ["content"]))
    if ranged:
        listed = listed.repartition(max(1, math.ceil(listed.count() / FILES_PER_TASK)))
    found = listed.mapInArrow(_read, _COLUMNS)
    path = scratch_path(spark, "column-inventory")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def schema_changes(inventory: DataFrame) -> DataFrame:
    """One row per column and type: its files and rows, the first and last file by name, and
    whether the column is missing from some files or has several types.

    ``change`` is same, partial, retyped, or both of the latter.
    """
    files = inventory.select("file_path", "file_rows").distinct()
    every = files.agg(F.struct(F.count(F.lit(1)).alias("files"), F.sum("file_rows").alias("rows"))).scalar()
    per_type = inventory.groupBy("column_name", "type").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_rows").alias("rows"),
        F.min("file_path").alias("first_file"),
        F.max("file_path").alias("last_file"),
    )
    per_column = per_type.groupBy("column_name").agg(F.count(F.lit(1)).alias("types"), F.sum("files").alias("column_files"))
    partial = F.when(F.col("column_files") < F.col("all_files"), F.lit("partial"))
    change = F.concat_ws(" and ", partial, F.when(F.col("types") > 1, F.lit("retyped")))
    return (
        per_type.join(per_column, "column_name")
        .withColumns({"all_files": every["files"], "all_rows": every["rows"]})
        .withColumn("change", F.coalesce(F.nullif(change, F.lit("")), F.lit("same")))
        .select("column_name", "type", "files", "rows", "all_files", "all_rows", "first_file", "last_file", "change")
    )


def files_that_differ(inventory: DataFrame) -> DataFrame:
    """The files that lack a column other files have, or hold it with a type that is not its
    most frequent one: file, column, the type found (null when missing) and the usual one."""
    kinds = inventory.groupBy("column_name", "type").agg(F.count(F.lit(1)).alias("files"))
    usual = kinds.groupBy("column_name").agg(F.max_by("type", F.struct("files", "type")).alias("usual_type"))
    schema = usual.agg(F.collect_list(F.struct("column_name", "usual_type"))).scalar()  # as long as a schema
    pairs = inventory.select("file_path").distinct().select("file_path", F.inline(schema))
    own = inventory.select("file_path", "column_name", "type")
    return pairs.join(own, ["file_path", "column_name"], "left").where("type is null or type <> usual_type")
