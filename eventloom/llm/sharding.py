"""Two-pass external shuffle of a corpus into shards.

Pass one scatters the records over buckets by a seeded hash of the whole record,
so a bucket is an even sample of the corpus that fits a task's memory. Pass two
shuffles each bucket (Fisher-Yates, seeded by the bucket) and writes it. Buckets
one after the other are a shuffled corpus; dealt out in turn, its records give
shards whose counts differ by one at most, and each shard's slots have no gap.
Every bucket is one partition (``repartitionById``), so no task gets several.

Before the shuffle a bucket's rows are put in a fixed order, so a task that runs
again gives the same result. What comes to the driver is one count per bucket.

Law: ``rows``. Defined cases: a null text has size 1 and checksum 0, and its row
is dealt like any other; so are empty texts, repeated rows and rows without an
id. Rows equal in id and text are interchangeable; where so many are equal that they
would fill a quarter of a full bucket, they are scattered over all, by their place. A very
long text makes its bucket larger. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from eventloom.llm.common import written
from eventloom.sources.scratch import scratch_path

SHARDS = 8
SEED = 20240917
#: Text bytes of a bucket, about.
BUCKET_BYTES = 24 << 20


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0..n-1: each place from the last down swaps with one at or before it."""
    out = np.arange(n)
    draws = np.random.default_rng((seed, bucket)).random(n)
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        out[i], out[j] = out[j], out[i]
    return out


def _shuffle(order: list[str], seed: int, shards: int, offsets):
    """For applyInArrow: a bucket in shuffled order, with shard and slot of each row."""

    def of(part: pa.Table) -> pa.Table:
        bucket = part.column("bucket")[0].as_py()
        keys = part.select(order).append_column("row", pa.array(np.arange(len(part))))
        fixed = pc.sort_indices(keys, [(c, "ascending") for c in keys.column_names])
        taken = fixed.to_numpy()[fisher_yates(len(part), seed, bucket)]
        place = offsets.value[bucket] + np.arange(len(part))
        shard, slot = place % shards, place // shards
        by_shard = np.lexsort((slot, shard))
        part = part.take(pa.array(taken[by_shard])).drop_columns(["bucket", "text_hash"])
        return part.append_column("shard", pa.array(shard[by_shard], pa.int32())).append_column("slot", pa.array(slot[by_shard], pa.int64()))

    return of


def _size(text: str):
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 64).cast("long")


def _bucket(buckets: int):
    return F.pmod("row_hash", F.lit(buckets)).cast("int")


def _filled(rows: DataFrame, buckets: int, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bytes of every bucket."""
    counts, held = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    found = rows.groupBy(_bucket(buckets).alias("bucket")).agg(F.count("*").alias("n"), F.sum(_size(text)).alias("bytes"))
    for r in found.toLocalIterator():  # one row per bucket
        counts[r["bucket"]], held[r["bucket"]] = r["n"], r["bytes"]
    return counts, held


def _spread_floods(rows: DataFrame, suspects: DataFrame, text: str, most: int) -> DataFrame:
    """The rows with another ``row_hash`` where equal ones hold more than ``most`` bytes.

    The list is bounded by all bytes over ``most``. The new hash follows from a row's place
    in its partition, so the rows are written: a task that runs again must not deal
    them otherwise.
    """
    flood = suspects.groupBy("row_hash").agg(F.count("*").alias("n"), F.sum(_size(text)).alias("bytes")).where((F.col("n") > 1) & (F.col("bytes") > most))
    flood = flood.select("row_hash", F.lit(True).alias("flood"))
    spread = rows.withColumn("flood_place", F.monotonically_increasing_id()).join(F.broadcast(flood), "row_hash", "left")
    spread = spread.withColumn("row_hash", F.when(F.col("flood"), F.xxhash64("row_hash", "flood_place")).otherwise(F.col("row_hash")))
    return written(spread.select(*rows.columns), "spread")


def sharded(docs: DataFrame, folder: str, *, shards: int = SHARDS, seed: int = SEED, doc: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Writes all rows with ``shard`` and ``slot`` to a Parquet table in ``folder``, by shard,
    and returns that table. The columns shard, slot, bucket, text_hash, row_hash, flood and flood_place must be free."""
    clash = {"shard", "slot", "bucket", "text_hash", "row_hash", "flood", "flood_place"} & set(docs.columns)
    if clash:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    size = docs.agg(F.sum(_size(text)).alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // bucket_bytes))
    rows = docs.withColumn("text_hash", F.xxhash64(text)).withColumn("row_hash", F.xxhash64(F.lit(seed), doc, "text_hash"))
    counts, held = _filled(rows, buckets, text)
    if held.max() > 2 * bucket_bytes:
        full = np.flatnonzero(held > 2 * bucket_bytes).tolist()  # at most half as many as buckets
        rows = _spread_floods(rows, rows.where(_bucket(buckets).isin(full)), text, bucket_bytes // 4)
        counts, _ = _filled(rows, buckets, text)
    rows = rows.withColumn("bucket", _bucket(buckets)).drop("row_hash")
    offsets = docs.sparkSession.sparkContext.broadcast(np.cumsum(counts) - counts)
    kinds = StructType([*docs.schema.fields]).add("shard", IntegerType()).add("slot", LongType())
    mixed = rows.repartitionById(buckets, "bucket").groupBy("bucket").applyInArrow(_shuffle([doc, "text_hash"], seed, shards, offsets), kinds)
    mixed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.schema(mixed.schema).parquet(folder)


def digest(docs: DataFrame, *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shards the documents and returns the contract's columns from the written shards."""
    found = sharded(docs, scratch_path(docs.sparkSession, "shards"), shards=shards, seed=seed)
    text = F.coalesce("text", F.lit(""))
    return found.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
