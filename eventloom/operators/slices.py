"""Cut hot keys along their order into slices of about equal row count.

A refining histogram finds the slices. A hot key's order values are counted in
bins; only bins that hold more than half a slice are counted again, in finer
bins between their own smallest and largest value, and a bin of one value goes
on by the tie breaker. What is left is a tree of bins, none of them above half
a slice unless its rows are equal in value and tie breaker. The rows before a
bin, summed in lanes of bins, name its slice.

A row finds its slice by joining the tree level by level on (key, bin), so the
work per row is one hash lookup per level (one level for values that lie evenly,
about three with a crowded moment) however many slices there are. All levels
are written tables: every branch of a later plan sees the same slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.hotkeys import HotKeys, key_hash
from eventloom.functions.sizing import MAX_BROADCAST_BYTES
from eventloom.sources.scratch import scratch_path

SLICE = "slice_no"
_HASH, _AT, _TIE, _NODE = "slice_hash", "slice_at", "slice_tie", "slice_node"
#: Bins of one row of a level's lookup table.
BLOCK = 64
#: Bins per slice in a first count, and the least for a node where nodes are few.
PER_SLICE, FEW_BINS = 4, 1024
#: Bins of a node that one task sums up.
LANE_BITS = 14
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _double_number(x: Column) -> Column:
    """The bits of a double as a number that rises with it; exact, as powers of two divide exactly."""
    size = F.abs(x)
    tiny = size < 2.0**-1022
    guess = F.floor(F.log2(F.when(~tiny, size))).cast("double")
    part = size / F.pow(F.lit(2.0), F.least(guess, F.lit(1023.0)))
    exponent = F.least(guess, F.lit(1023.0)) - F.when(part < 1, 1.0).otherwise(0.0) + F.when(part >= 2, 1.0).otherwise(0.0)
    part = size / F.pow(F.lit(2.0), exponent)
    normal = (exponent + 1023).cast("bigint") * F.lit(2**52) + ((part - 1) * F.lit(2.0**52)).cast("bigint")
    number = F.when(tiny, (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")).otherwise(normal)
    number = F.when(size == float("inf"), F.lit(2047 * 2**52)).otherwise(number)
    return F.when(F.isnan(x), F.lit(2047 * 2**52 + 1)).when(x < 0, -number).otherwise(number)


def order_number(column: Column, kind: T.DataType) -> Column | None:
    """A bigint that rises with the value, equal only for equal values; None for a type that has none here."""
    if isinstance(kind, _INTEGRAL):
        return column.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(column.cast("date")).cast("bigint") * F.lit(86_400_000_000)
        clock = F.hour(column) * F.lit(3_600_000_000) + F.minute(column).cast("bigint") * F.lit(60_000_000)
        micros = (F.date_part(F.lit("SECOND"), column) * F.lit(1_000_000)).cast("bigint")
        return day + clock + micros
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _double_number(column.cast("double"))
    return None


@dataclass(frozen=True)
class Cuts:
    """The tree of bins: the hot keys' first nodes, and per level the bins with
    their slices and finer nodes. ``wide`` tells which levels are too large to broadcast."""

    keys: tuple[str, ...]
    roots: DataFrame
    levels: tuple[DataFrame, ...] = ()
    wide: tuple[bool, ...] = ()


def _written(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """The rows as a written table, and aggregates observed in the write."""
    path, seen = scratch_path(df.sparkSession, label), Observation()
    df.observe(seen, *[c.alias(name) for name, c in measures.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def _node(n: Column, least: int) -> Column:
    """A bin's node of finer bins, by its rows and smallest and largest values: where it starts
    in value and in rows, the column it is cut by, the shift from a value to a bin, the first bin."""
    on_tie = F.col("low_at") == F.col("high_at")
    low = F.when(on_tie, F.col("low_tie")).otherwise(F.col("low_at"))
    high = F.when(on_tie, F.col("high_tie")).otherwise(F.col("high_at"))
    bins = F.greatest(F.lit(float(least)), F.lit(float(PER_SLICE)) * n * F.col("pieces") / F.col("key_rows"))
    span = high.cast("double") - low.cast("double") + 1.0
    shift = F.greatest(F.lit(0), F.ceil(F.log2(span / bins))).cast("int")
    return F.struct(
        F.col("low_at").alias("at"),
        F.col("low_tie").alias("tie"),
        on_tie.alias("on_tie"),
        shift.alias("shift"),
        F.call_function("shiftright", low, shift).alias("base"),
        F.col("start"),
        F.col("key_rows"),
        F.col("pieces"),
    )


def _bin() -> Column:
    value = F.when(F.col(f"{_NODE}.on_tie"), F.col(_TIE)).otherwise(F.col(_AT))
    return F.call_function("shiftright", value, F.col(f"{_NODE}.shift")) - F.col(f"{_NODE}.base")


def _placed(df: DataFrame, keys: Sequence[str], order_by: str, tie: Column) -> DataFrame:
    at = order_number(F.col(order_by), df.schema[order_by].dataType)
    return df.withColumns({_HASH: key_hash(keys), _AT: at, _TIE: tie})


def _rooted(rows: DataFrame, cuts: Cuts, how: str) -> DataFrame:
    """Rows of hot keys at their first node; missing values come first, as in a window."""
    roots = F.broadcast(cuts.roots.toDF("cut_hash", _NODE))  # one row per hot key
    rows = rows.join(roots, F.col(_HASH) == F.col("cut_hash"), how)
    return rows.withColumns({_AT: F.coalesce(_AT, F.col(f"{_NODE}.at")), SLICE: F.lit(0)})


def _descend(rows: DataFrame, cuts: Cuts) -> DataFrame:
    """Follow rows with a node through all levels: ``SLICE``, and the node they still lack."""
    for bins, wide in zip(cuts.levels, cuts.wide, strict=True):
        rows = rows.withColumn("slice_bin", _bin())
        node = F.col(_NODE)
        same = (node["at"] == F.col("cell_at")) & (node["tie"] == F.col("cell_tie"))
        if wide:
            # rows without a node match nothing; the tie breaker spreads them over the tasks
            rows = rows.withColumn("slice_side", F.when(node.isNotNull(), F.col(_HASH)).otherwise(F.col(_TIE)))
            on = (F.col("slice_side") == F.col("cell_hash")) & same & (F.col("slice_bin") == F.col("bin"))
            rows = rows.join(bins, on, "left").drop("slice_side")
            found, child = F.col("bin_slice"), F.col("child")
        else:
            on = (F.col(_HASH) == F.col("cell_hash")) & same & (F.shiftright("slice_bin", 6) == F.col("block"))
            rows = rows.join(F.broadcast(_blocks(bins)), on, "left")
            place = F.col("slice_bin").bitwiseAND(F.lit(BLOCK - 1)).cast("int")
            found, child = F.get("bin_slice", place), F.get("child", place)
        rows = rows.withColumns({SLICE: F.coalesce(found, F.col(SLICE)), _NODE: child})
        rows = rows.drop("slice_bin", "cell_hash", "cell_at", "cell_tie", "bin", "block", "bin_slice", "child")
    return rows


def _blocks(bins: DataFrame) -> DataFrame:
    """``BLOCK`` bins per row, found by their place in an array."""
    at = F.col("bin").bitwiseAND(F.lit(BLOCK - 1)).cast("int")
    cells = bins.groupBy("cell_hash", "cell_at", "cell_tie", F.shiftright("bin", 6).alias("block")).agg(
        F.map_from_entries(F.collect_list(F.struct(at, F.struct("bin_slice", "child")))).alias("by_place")
    )
    places = F.sequence(F.lit(0), F.lit(BLOCK - 1))
    pick = lambda field: F.transform(places, lambda i: F.try_element_at(F.col("by_place"), i)[field])
    return cells.select(
        "cell_hash", "cell_at", "cell_tie", "block", pick("bin_slice").alias("bin_slice"), pick("child").alias("child")
    )


def _counted(rows: DataFrame) -> DataFrame:
    """Rows and extreme values per bin of the nodes that rows stand at."""
    return (
        rows.where(F.col(_NODE).isNotNull())
        .groupBy(
            F.col(_HASH).alias("cell_hash"),
            F.col(f"{_NODE}.at").alias("cell_at"),
            F.col(f"{_NODE}.tie").alias("cell_tie"),
            _bin().alias("bin"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(_AT).alias("low_at"),
            F.max(_AT).alias("high_at"),
            F.min(_TIE).alias("low_tie"),
            F.max(_TIE).alias("high_tie"),
            *[F.any_value(f"{_NODE}.{c}").alias(c) for c in ("start", "key_rows", "pieces")],
        )
    )


def _sliced_bins(counts: DataFrame, least: int, lanes: bool) -> DataFrame:
    """The bins of one level with the rows of their key before them, slice and finer node.

    With ``lanes`` in two running sums, over a node's lanes and inside a lane, so that
    no task holds more than a lane of a key's bins.
    """
    node = ["cell_hash", "cell_at", "cell_tie"]
    inside = node
    earlier = F.lit(0)
    if lanes:
        counts = counts.withColumn("lane", F.shiftright("bin", LANE_BITS))
        inside = [*node, "lane"]
        before = Window.partitionBy(*node).orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
        sums = counts.groupBy(*inside).agg(F.sum("n").alias("lane_rows"))
        sums = sums.withColumn("before_lane", F.coalesce(F.sum("lane_rows").over(before), F.lit(0))).drop("lane_rows")
        counts, earlier = counts.join(sums, inside), F.col("before_lane")
    upto = Window.partitionBy(*inside).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("start") + earlier + F.coalesce(F.sum("n").over(upto), F.lit(0))
    found = counts.withColumn("start", start)
    # in doubles: rows times pieces may pass a bigint, and a boundary between slices need not be exact
    share = F.col("start").cast("double") * F.col("pieces") / F.col("key_rows")
    one_place = (F.col("low_at") == F.col("high_at")) & (F.col("low_tie") == F.col("high_tie"))
    finer = (2.0 * F.col("n") * F.col("pieces") > F.col("key_rows")) & ~one_place
    return found.select(
        *node,
        "bin",
        F.least(F.floor(share), F.col("pieces") - 1).cast("int").alias("bin_slice"),
        F.when(finer, _node(F.col("n"), least)).alias("child"),
    )


def find_cuts(df: DataFrame, keys: Sequence[str], order_by: str, tie: Column, hot: HotKeys) -> Cuts | None:
    """The slices of the hot keys; None where the order has a type that cannot be counted in bins.

    One pass over the key, order and tie columns for the ranges, and one per level.
    """
    if order_number(F.col(order_by), df.schema[order_by].dataType) is None:
        return None
    table = F.broadcast(hot.table(df.sparkSession))
    rows = _placed(df, keys, order_by, tie).select(_HASH, _AT, _TIE)
    ranges = (
        rows.join(table, F.col(_HASH) == F.col("hot_hash"))
        .groupBy(F.col("hot_hash").alias("cell_hash"), F.col("hot_pieces").alias("pieces"))
        .agg(
            F.count(F.lit(1)).alias("key_rows"),
            F.min(_AT).alias("low"),
            F.coalesce(F.max(_AT), F.lit(0)).alias("high_at"),
            F.count_if(F.col(_AT).isNull()).alias("missing"),
            F.min(_TIE).alias("low_tie"),
            F.max(_TIE).alias("high_tie"),
        )
    )
    # missing values stand one before the smallest, or alone
    low = F.when(F.col("missing") == 0, F.col("low")).otherwise(F.coalesce(F.col("low") - 1, F.lit(0)))
    ranges = ranges.withColumn("low_at", low).withColumn("start", F.lit(0).cast("bigint"))
    nodes, _ = _written(ranges.select("cell_hash", _node(F.col("key_rows"), FEW_BINS).alias("child")), "slice-roots", n=F.count(F.lit(1)))
    cuts, least = Cuts(tuple(keys), nodes), FEW_BINS
    start = _rooted(rows, cuts, "inner")
    lanes = PER_SLICE * max(n for _, n in hot.pieces) >> LANE_BITS > 0
    while True:
        counts = _counted(_descend(start, cuts))
        place = F.xxhash64("cell_hash", "cell_at", "cell_tie", F.shiftright("bin", 6))
        finer = F.count("child")
        level, seen = _written(
            _sliced_bins(counts, least, lanes), "slice-bins", finer=finer, blocks=F.approx_count_distinct(place)
        )
        # a row of blocks holds an array of slices and one of nodes, few of which are there
        wide = 2 * seen["blocks"] * 16 * BLOCK + seen["finer"] * 96 > MAX_BROADCAST_BYTES
        cuts = Cuts(cuts.keys, cuts.roots, (*cuts.levels, level), (*cuts.wide, wide))
        if not seen["finer"]:
            return cuts
        least = min(FEW_BINS, max(BLOCK, (1 << 16) // seen["finer"]))


def add_slices(df: DataFrame, order_by: str, tie: Column, cuts: Cuts) -> DataFrame:
    """Add the slice number, 0 for ordinary keys and rising with the order in hot
    ones, the tie breaker as ``slice_tie``, and ``cut_hash``, null for ordinary keys."""
    rows = _rooted(_placed(df, cuts.keys, order_by, tie), cuts, "left")
    return _descend(rows, cuts).drop(_HASH, _AT, _NODE)
