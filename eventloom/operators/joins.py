"""Joins on skewed keys, enrichment, membership, coverage and pair counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.hotkeys import TASK_BYTES, HotKeys, find_hot_keys, key_hash
from eventloom.functions.salt import SALT, pick_spread, row_salt
from eventloom.functions.sizing import MAX_BROADCAST_BYTES, fits_broadcast

# the right side may be repeated only where an unmatched right row is not kept
_SALTABLE = ("inner", "left", "left_semi", "left_anti")


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _check_kind(how: str) -> None:
    if how not in _SALTABLE:
        raise ValueError(f"a {how} join cannot repeat its right side; use one of {_SALTABLE}")


def _repeat(right: DataFrame, pieces: Column) -> DataFrame:
    """Each right row once per salt 0..pieces-1."""
    return right.withColumn(SALT, F.explode(F.sequence(F.lit(0), pieces - F.lit(1))))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    *,
    buckets: int,
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Spread every key of the left side over ``buckets`` tasks.

    Each left row has one salt and each right row has them all, so every pair
    meets exactly once and the result equals the plain join.
    """
    _check_kind(how)
    keys = _names(on)
    salted = left.withColumn(SALT, row_salt(pick_spread(left, spread_by), buckets))
    return salted.join(_repeat(right, F.lit(buckets)), [*keys, SALT], how).drop(SALT)


def hot_key_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    *,
    how: str = "inner",
    hot: HotKeys | None = None,
    spread: int | None = None,
    spread_by: Sequence[str] | None = None,
    max_bytes: int = MAX_BROADCAST_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Salt only keys that are too big for one task; others join as they are.

    A right side within ``max_bytes`` is broadcast and nothing is shuffled.
    Beyond it each hot key is cut in proportion to its share on either side, and
    only its rows on the other side are repeated; a right side that one task can
    hold, ``task_bytes``, has none. Without hot keys this is the plain join. Left
    rows with a null key match nothing, so in a left join they are spread over
    all salts. A semi or anti join needs each right key once. A left join with a
    key that is hot on the right is an inner and an anti join, as its left rows
    cannot be repeated.
    """
    _check_kind(how)
    keys = _names(on)
    if fits_broadcast(right, max_bytes):
        return left.join(F.broadcast(right), keys, how)
    hot = find_hot_keys(left, keys, spread=spread) if hot is None else hot
    if how in ("left_semi", "left_anti"):
        right, hot_right = right.select(*keys).distinct(), HotKeys(tuple(keys))
    elif fits_broadcast(right, task_bytes):
        hot_right = HotKeys(tuple(keys))
    else:
        present = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
        hot_right = find_hot_keys(right.where(present), keys, spread=spread)
    if hot_right and how == "left":
        options = dict(hot=hot, spread=spread, spread_by=spread_by, max_bytes=max_bytes, task_bytes=task_bytes)
        met, alone = (hot_key_join(left, right, on, how=kind, **options) for kind in ("inner", "left_anti"))
        return met.unionByName(alone, allowMissingColumns=True)
    if not hot and not hot_right:
        return left.join(right, keys, how)

    def tagged(df: DataFrame) -> DataFrame:
        """With how many pieces the left and the right rows of the key are cut into."""
        out = df.withColumn("key_hash", key_hash(keys))
        for found, name in ((hot, "cuts"), (hot_right, "cuts_right")):
            table = found.table(df.sparkSession).toDF("hot_hash", name)  # at most half as many rows as tasks
            out = out.join(F.broadcast(table), F.col("key_hash") == F.col("hot_hash"), "left").drop("hot_hash")
            out = out.withColumn(name, F.coalesce(name, F.lit(1)))
        return out

    extra = ("key_hash", "cuts", "cuts_right")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - F.lit(1)))
    salted = tagged(left).withColumn(SALT, row_salt(pick_spread(left, spread_by), F.col("cuts")))
    repeated = tagged(right).withColumn(SALT, every("cuts"))
    salts = [SALT]
    if hot_right:
        salts.append(SALT + "_right")
        salted = salted.withColumn(salts[1], every("cuts_right"))
        repeated = repeated.withColumn(salts[1], row_salt(pick_spread(right, None), F.col("cuts_right")))
    return salted.drop(*extra).join(repeated.drop(*extra), [*keys, *salts], how).drop(*salts)


def counted_side(df: DataFrame, key: str, name: str = "partners") -> DataFrame:
    """One side of a counting join shrunk to one row per key with its row count."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).cast("decimal(19,0)").alias(name))
    )


def pair_counts(
    left: DataFrame, right: DataFrame | None, key: str, name: str = "total"
) -> DataFrame:
    """Pairs per key of ``left join right on key``, without forming a pair;
    ``right`` None pairs the left side with itself.

    Both sides shrink to one count per key before they meet, so a key with n
    and m rows costs two counts, not n * m rows. The product is a
    decimal(38,0): it passes a bigint long before the counts do.
    """
    sizes = counted_side(left, key, "n_left")
    if right is None:
        both = sizes.withColumn("n_right", F.col("n_left"))
    else:
        both = sizes.join(counted_side(right, key, "n_right"), key)
    pairs = (F.col("n_left") * F.col("n_right")).cast("decimal(38,0)")
    return both.select(key, pairs.alias(name))


def sum_partners(joined: DataFrame, key: str, name: str = "total") -> DataFrame:
    """Pairs per key from rows that each carry their number of partners."""
    return joined.groupBy(key).agg(F.sum("partners").cast("decimal(38,0)").alias(name))


def enrich(
    fact: DataFrame,
    dimension: DataFrame,
    on: str,
    *,
    strategy: str = "auto",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of a fact table with a dimension.

    ``shuffle`` asks for a sort-merge join, ``broadcast`` for a broadcast when
    the dimension's estimated size is within ``max_bytes``; beyond it, and for
    ``salted``, hot keys are spread. ``auto`` leaves it to the optimizer's own
    threshold. A sort-merge join spreads hot keys as well.
    """
    if strategy == "broadcast":
        return hot_key_join(fact, dimension, on, max_bytes=max_bytes)
    if strategy == "shuffle":
        return hot_key_join(fact, dimension.hint("merge"), on, max_bytes=0)
    if strategy == "salted":
        return hot_key_join(fact, dimension, on, max_bytes=0)
    if strategy == "auto":
        return fact.join(dimension, on, "inner")
    raise ValueError(f"unknown strategy {strategy}")


def only_listed(
    df: DataFrame,
    ids: DataFrame,
    key: str,
    *,
    max_bytes: int = MAX_BROADCAST_BYTES,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose key is in a list of ids. A list within ``max_bytes`` is
    broadcast; for a longer one both sides are shuffled, hot keys spread."""
    listed = ids.select(key)
    if fits_broadcast(listed, max_bytes):
        return df.join(F.broadcast(listed), key, "left_semi")
    return hot_key_join(df, listed, key, how="left_semi", spread_by=spread_by, max_bytes=0)


def key_coverage(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """One row: distinct fact keys, how many the dimension knows, and the percentage."""
    ours = fact.select(key).where(F.col(key).isNotNull()).distinct()
    known = dimension.select(key).distinct().withColumn("known", F.lit(1))
    met = F.count("known")
    return ours.join(known, key, "left").agg(
        F.count(F.lit(1)).alias("keys"),
        met.alias("covered"),
        (met * F.lit(100.0) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("coverage_pct"),
    )
