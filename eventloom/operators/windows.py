"""Ordered work per key that stays even when one key holds a third of all rows.

Keys of ordinary size go through a plain window. A hot key is cut along its
order into slices of about equal row count (``operators.slices``), so several
tasks share it; what a slice needs from earlier ones (their last moment, their
running total) is one row per slice, few enough by construction to broadcast.

Where many rows of a hot key share one moment, they are cut by the tie-breaking
column. Only rows equal in both stay together, so the tie breaker should tell
rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.hotkeys import HotKeys, find_hot_keys
from eventloom.functions.moments import gap_seconds
from eventloom.functions.salt import pick_spread
from eventloom.operators.slices import SLICE, Cuts, add_slices, find_cuts

_TIE = "slice_tie"

def _attach(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the one carried row per (hot key, slice) to the rows of that slice."""
    right = carried.select(
        *[F.col(k).alias(f"carry_{k}") for k in (*keys, SLICE)],
        *[c for c in carried.columns if c not in (*keys, SLICE)],
    )
    condition = None
    for k in (*keys, SLICE):
        same = F.col(k).eqNullSafe(F.col(f"carry_{k}"))
        condition = same if condition is None else condition & same
    return rows.join(F.broadcast(right), condition, "left").drop(*[f"carry_{k}" for k in (*keys, SLICE)])


def _plan(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str,
    tie: Column,
    hot: HotKeys | None,
    spread: int | None,
) -> tuple[list[str], Cuts | None]:
    names = [keys] if isinstance(keys, str) else list(keys)
    hot = find_hot_keys(df, names, spread=spread) if hot is None else hot
    return names, find_cuts(df, names, order_by, tie, hot) if hot else None


def with_previous(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str,
    *,
    name: str = "previous_timestamp",
    spread_by: Sequence[str] | None = None,
    hot: HotKeys | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Add the previous value of ``order_by`` within each key; null for the first.

    One shuffle of the rows whichever way a key goes. ``spread_by`` names
    columns that tell rows apart; it only matters where a hot key has very many
    rows at one moment.
    """
    tie = F.xxhash64(*[F.col(c) for c in pick_spread(df, spread_by)])
    names, cuts = _plan(df, keys, order_by, tie, hot, spread)
    if cuts is None:
        return df.withColumn(name, F.lag(order_by).over(Window.partitionBy(*names).orderBy(order_by)))
    sliced = add_slices(df, order_by, tie, cuts).drop(_TIE)
    inside = Window.partitionBy(*names, SLICE).orderBy(order_by)
    ends = (
        sliced.where(F.col("cut_hash").isNotNull())
        .groupBy(*names, SLICE)
        .agg(F.max(order_by).alias("slice_end"))
        .withColumn("carried", F.lag("slice_end").over(Window.partitionBy(*names).orderBy(SLICE)))
        .drop("slice_end")
    )
    rows = sliced.drop("cut_hash").withColumn(name, F.lag(order_by).over(inside))
    return (
        _attach(rows, ends, names)
        .withColumn(name, F.coalesce(F.col(name), F.col("carried")))
        .drop("carried", SLICE)
    )


def with_gaps(
    df: DataFrame, key: str, time: str, *, name: str = "gap_seconds", **options
) -> DataFrame:
    """Add ``previous_timestamp`` and the whole-second gap to it."""
    seen = with_previous(df, key, time, name="previous_timestamp", **options)
    return seen.withColumn(name, gap_seconds(F.col(time), F.col("previous_timestamp")))


def running_anchor(
    df: DataFrame,
    key: str,
    time: str,
    step: str,
    tie: str,
    *,
    name: str = "anchor",
    hot: HotKeys | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Time of a key's first row plus the steps of its later rows up to each row.

    Rows are ordered by ``time`` and then by ``tie``, a bigint that is unique
    within the key; ``step`` is in seconds.
    """
    names, cuts = _plan(df, key, time, F.col(tie), hot, spread)
    if cuts is None:
        order = Window.partitionBy(*names).orderBy(time, tie)
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        moved = F.sum(step).over(upto) - F.first(step).over(upto)
        return df.withColumn(name, F.first(time).over(upto) + F.make_dt_interval(secs=moved))

    sliced = add_slices(df, time, F.col(tie), cuts).drop(_TIE)
    hot_rows = sliced.where(F.col("cut_hash").isNotNull())
    sums = hot_rows.groupBy(*names, SLICE).agg(F.sum(step).alias("slice_sum"))
    heads = (
        hot_rows.where(F.col(SLICE) == 0)
        .groupBy(*names, SLICE)
        .agg(F.min(F.struct(time, tie, step)).alias("slice_head"))
    )
    per_slice = (
        sums.unionByName(heads, allowMissingColumns=True)
        .groupBy(*names, SLICE)
        .agg(F.max("slice_sum").alias("slice_sum"), F.min("slice_head").alias("slice_head"))
    )
    earlier = Window.partitionBy(*names).orderBy(SLICE)
    carried = per_slice.select(
        *names,
        SLICE,
        F.coalesce(
            F.sum("slice_sum").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("carried_sum"),
        F.first("slice_head").over(earlier).alias("key_head"),
    )
    upto = (
        Window.partitionBy(*names, SLICE)
        .orderBy(time, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = (
        sliced.drop("cut_hash")
        .withColumn("inside_sum", F.sum(step).over(upto))
        .withColumn("inside_head", F.first(F.struct(time, tie, step)).over(upto))
    )
    start = F.coalesce(F.col("key_head"), F.col("inside_head"))
    moved = F.coalesce("carried_sum", F.lit(0)) + F.col("inside_sum") - start[step]
    return (
        _attach(rows, carried, names)
        .withColumn(name, start[time] + F.make_dt_interval(secs=moved))
        .drop("carried_sum", "key_head", "inside_sum", "inside_head", SLICE)
    )


def top_per_group(
    df: DataFrame, group: str, value: str, n: int, ties: Sequence[str], *, rank: str = "rn"
) -> DataFrame:
    """The ``n`` rows with the largest value per group, nulls last, ties by ``ties``.

    Spark cuts each input partition to ``n`` rows per group before the shuffle,
    so the size of a group does not matter.
    """
    order = Window.partitionBy(group).orderBy(
        F.col(value).desc_nulls_last(), *[F.col(t).asc_nulls_first() for t in ties]
    )
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= n)


def path_names(df: DataFrame, file_column: str = "file_path") -> DataFrame:
    """The hash of each path as ``file_key``, and the path; two paths with one hash stop the job."""
    names = (
        df.select(file_column)
        .distinct()
        .groupBy(F.xxhash64(file_column).alias("file_key"))
        .agg(F.min(file_column).alias(file_column), F.count(F.lit(1)).alias("paths"))
    )
    clash = F.raise_error(F.lit("two files share a path hash")).cast("string")
    return names.select("file_key", F.when(F.col("paths") > 1, clash).otherwise(F.col(file_column)).alias(file_column))


def overlapping(ranges: DataFrame, number: str, low: str, high: str, *, block: int = 4096) -> DataFrame:
    """One row: ranges, and how many start before the one above them, by ``number``, ends.

    Ranges are compared in blocks of numbers, and the blocks' seams after that, so no
    task sees them all.
    """
    rows = ranges.select(F.floor(F.col(number) / F.lit(block)).alias("block"), number, low, high)
    inside = Window.partitionBy("block").orderBy(number)
    blocks = rows.withColumn("above", F.lag(high).over(inside)).groupBy("block").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(low) < F.col("above")).alias("bad"),
        F.min_by(low, number).alias("first_low"),
        F.max_by(high, number).alias("last_high"),
    )
    seams = blocks.withColumn("above", F.lag("last_high").over(Window.partitionBy(F.lit(0)).orderBy("block")))
    return seams.agg(
        F.sum("n").alias("ranges"), (F.sum("bad") + F.count_if(F.col("first_low") < F.col("above"))).alias("overlaps")
    )


def out_of_order(
    df: DataFrame,
    time: str,
    *,
    file_column: str = "file_path",
    row_column: str = "row_index",
    block_rows: int = 1_000_000,
) -> DataFrame:
    """One row per file: rows, and rows whose time is before the stored row above.

    Files are cut into blocks of stored rows, so a huge file is many tasks;
    the seams between blocks are checked from one first and last time per block.
    Rows travel under a hash of the path, which is far shorter than the path;
    the paths come back at the end, and two with one hash would stop the job.
    """
    names = path_names(df, file_column)
    block = F.floor(F.col(row_column) / F.lit(block_rows)).alias("block")
    rows = df.select(F.xxhash64(file_column).alias("file_key"), block, row_column, time)
    inside = Window.partitionBy("file_key", "block").orderBy(row_column)
    blocks = (
        rows.withColumn("above", F.lag(time).over(inside))
        .groupBy("file_key", "block")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(time) < F.col("above")).alias("bad"),
            F.min_by(time, row_column).alias("first_time"),
            F.max_by(time, row_column).alias("last_time"),
        )
    )
    seams = Window.partitionBy("file_key").orderBy("block")
    per_file = (
        blocks.withColumn("before", F.lag("last_time").over(seams))
        .groupBy("file_key")
        .agg(
            F.sum("n").alias("rows"),
            (F.sum("bad") + F.count_if(F.col("first_time") < F.col("before"))).alias("out_of_order"),
        )
    )
    return per_file.join(names, "file_key").select(file_column, "rows", "out_of_order")
