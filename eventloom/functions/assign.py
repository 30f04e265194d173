"""Ids, category choices and masks built from stable draws, never from rand()."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and the number padded with zeros; wider numbers keep all digits."""
    digits = number.cast("bigint").cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def pick_weighted(draw: Column, weights: Mapping[str, float]) -> Column:
    """The category whose cumulative weight first exceeds ``draw``.

    ``draw`` and the weights share one scale: [0, 1) with shares, or whole
    numbers with per-10,000 weights.
    """
    names = list(weights)
    if not names:
        raise ValueError("no categories given")
    reached = 0.0
    choice = None
    for name in names[:-1]:
        reached += weights[name]
        hit = draw < F.lit(reached)
        choice = F.when(hit, F.lit(name)) if choice is None else choice.when(hit, F.lit(name))
    last = F.lit(names[-1])
    return last if choice is None else choice.otherwise(last)


def pick_uniform(number: Column, names: Sequence[str]) -> Column:
    """One of ``names`` by the remainder of an integer column."""
    place = F.pmod(number, F.lit(len(names))).cast("int") + F.lit(1)
    return F.elt(place, *[F.lit(name) for name in names])


def two_tier(mask: Column, yes: Column | str, no: Column | str) -> Column:
    """``yes`` where the mask holds, otherwise ``no``."""
    pick = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(mask, pick(yes)).otherwise(pick(no))


def null_where(mask: Column, value: Column) -> Column:
    """``value``, emptied where the mask holds; an unknown mask keeps the value."""
    return F.when(F.coalesce(mask, F.lit(False)), F.lit(None)).otherwise(value)


def sample_keys(df: DataFrame, key: str, size: int, order: Column | None = None) -> DataFrame:
    """A repeatable sample of ``size`` distinct keys without replacement."""
    rank = F.xxhash64(key) if order is None else order
    return df.select(key).distinct().orderBy(rank, F.col(key)).limit(size)
