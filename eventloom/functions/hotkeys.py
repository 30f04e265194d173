"""Find the few keys that hold too many rows for one task.

The search is one pass over the key columns with Spark's frequent-items
sketch, merged in levels. A lane is a few neighbouring input splits, cut by key
hash where one sketch could not tell so small shares apart; only a lane's own
sketches meet in a task. Of a lane go on the keys that hold a part of the share
there, as plain rows, summed by key over all lanes and cut by share again: a key
with the share over all rows has it in some lanes, and what it loses in the
others is a quarter of the share at most. The bounded answer is read once and
frozen: every branch of a later plan sees the same list, which is what keeps
salted sides consistent.

A key the sketch overlooks is only left on the ordinary path. The list picks
how rows are spread; it never decides which rows take part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.sizing import estimated_bytes, source_bytes

#: Input splits whose sketches one task merges.
SPLITS_PER_LANE = 16
#: Bytes that one task should get at most; what a key may hold before it is hot.
TASK_BYTES = 256 * 1024 * 1024
#: Items one sketch follows.
MIN_TRACKED, MAX_TRACKED = 1024, 250_000


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of the key columns; nulls hash like any other value."""
    return F.xxhash64(*[F.col(k) for k in keys])


@dataclass(frozen=True)
class HotKeys:
    """Hashes of hot keys and into how many pieces each should be cut."""

    keys: tuple[str, ...]
    pieces: tuple[tuple[int, int], ...] = ()

    def __bool__(self) -> bool:
        return bool(self.pieces)

    def table(self, spark: SparkSession) -> DataFrame:
        """The list as a table; at most half as many rows as there are tasks."""
        return spark.createDataFrame(list(self.pieces), "hot_hash bigint, hot_pieces int")


def target_tasks(df: DataFrame) -> int:
    """Reduce tasks the session plans for, before adaptive execution merges any."""
    conf = df.sparkSession.conf
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(first or conf.get("spark.sql.shuffle.partitions"))


def planned_tasks(df: DataFrame) -> int:
    """Tasks for this table: what the session plans, or more where those would exceed ``TASK_BYTES``.

    Catalyst multiplies the sides of a join, so the tables read bound its estimate.
    A size that is not known leaves the session's number.
    """
    sizes = [size for size in (estimated_bytes(df), source_bytes(df)) if size is not None]
    return max(target_tasks(df), math.ceil(min(sizes) / TASK_BYTES) if sizes else 0)


def find_hot_keys(
    df: DataFrame,
    keys: str | Sequence[str],
    *,
    spread: int | None = None,
    min_share: float | None = None,
) -> HotKeys:
    """Keys holding at least ``min_share`` of the rows, default two tasks' fair part.

    A key with share s of the rows is cut into ceil(s * spread) pieces, so all
    pieces of all hot keys together number at most ``spread`` plus the keys.
    """
    names = (keys,) if isinstance(keys, str) else tuple(keys)
    tasks = spread or planned_tasks(df)
    share = min_share if min_share is not None else min(0.5, 2.0 / tasks)
    # a sketch errs by 3.5 / tracked of its rows, so this many tell the keys of half a share apart
    wanted = math.ceil(8.0 / share)
    buckets = math.ceil(wanted / MAX_TRACKED)
    tracked = max(MIN_TRACKED, math.ceil(wanted / buckets))
    lane = F.call_function("div", F.spark_partition_id(), F.lit(SPLITS_PER_LANE))
    hashed = df.select(key_hash(names).alias("h"), lane.alias("lane"))
    lanes = hashed.groupBy("lane", F.pmod("h", F.lit(buckets)).alias("bucket")).agg(
        F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    top = F.expr(f"approx_top_k_estimate(sketch, {min(tracked, math.floor(4.0 / share))})")
    many = F.filter(top, lambda item: item["count"] >= F.col("n") * F.lit(share / 4))
    # all rows of the lane go along as a row without a key
    every = F.array(F.struct(F.lit(None).cast("bigint").alias("item"), F.col("n").alias("count")))
    sums = lanes.select(F.inline(F.concat(every, many))).groupBy("item").agg(F.sum("count").alias("n"))
    total = sums.where(F.col("item").isNull()).select("n").scalar()
    found = sums.where(F.col("n") >= total * F.lit(share / 2)).collect()
    # at most 1 / share keys reach the share
    rows = next((r["n"] for r in found if r["item"] is None), 0)
    hot = sorted(((r["item"], r["n"]) for r in found if r["item"] is not None), key=lambda x: (-x[1], x[0]))
    pieces = tuple((h, max(2, math.ceil(tasks * n / rows))) for h, n in hot if n >= share * rows * 0.75)
    return HotKeys(names, pieces)
