"""Rounded means and minutes that do not depend on summation order.

Sums of doubles change with the order rows arrive in, and so can a rounded
mean. Where every value of a group is a whole number of hundredths, the group is
summed in those, as two bigints of high and low bits, which stays exact and inside
generated code for 9 billion of the largest values. A group with any other value (more decimals, NaN, infinity) takes the plain
``round(sum / count, 2)`` of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Below this a double's hundredths are exact whole numbers.
_EXACT_BELOW = 1e13


def hundredths(value: Column) -> Column:
    """A two-decimal double as a whole number of hundredths, to the nearest one.

    floor(x + 0.5) stays in primitive arithmetic; round() goes through BigDecimal.
    """
    return F.floor(value * F.lit(100.0) + F.lit(0.5)).cast("bigint")


def _whole(value: Column) -> Column:
    """Is the value the double nearest to some number of hundredths? NaN is not."""
    near = F.floor(F.when(F.abs(value) < _EXACT_BELOW, value) * F.lit(100.0) + F.lit(0.5))
    return F.coalesce(near / F.lit(100.0) == value, F.lit(False))


def half_up(numerator: Column, denominator: Column) -> Column:
    """Whole decimals: numerator / denominator rounded half away from zero, as bigint; null over 0."""
    safe = F.nullif(denominator, F.lit(0).cast("decimal(19,0)"))
    size = F.call_function("div", F.abs(numerator) * F.lit(2) + safe, safe * F.lit(2))
    return F.when(numerator < 0, -size).otherwise(size)


#: Low bits of an exact sum that are summed apart.
_LOW_BITS = 20
#: What a mean or a sum travels as: exact sum in two parts, values outside it, plain sum, count.
PARTS = ("high", "low", "others", "plain", "n")


def parts_of(value: Column) -> list[Column]:
    """Aggregates ``PARTS`` over the non-null values."""
    cents = F.when(_whole(value), hundredths(value))
    return [
        F.sum(F.shiftright(cents, _LOW_BITS)).alias("high"),
        F.sum(cents.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).alias("low"),
        F.count_if(value.isNotNull() & ~_whole(value)).alias("others"),
        F.sum(value).alias("plain"),
        F.count(value).alias("n"),
    ]


def parts_again() -> list[Column]:
    """Aggregates ``PARTS`` over rows that have them already."""
    return [F.sum(name).alias(name) for name in PARTS]


def _exact_sum(high: Column, low: Column) -> Column:
    return high.cast("decimal(19,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(19,0)")


def mean_from(high: Column, low: Column, others: Column, plain: Column, n: Column) -> Column:
    """Mean with two decimals, from ``PARTS``; null without values."""
    exact = half_up(_exact_sum(high, low), n.cast("decimal(19,0)")) / F.lit(100.0)
    return F.when(others == 0, exact).otherwise(F.round(plain / F.nullif(n, F.lit(0)), 2))


def exact_mean(value: Column) -> Column:
    """Aggregate: mean of non-null values to two decimals; null when all are null."""
    return mean_from(*parts_of(value))


def exact_minutes(seconds: Column) -> Column:
    """Aggregate: summed seconds as minutes with two decimals; null when all are null."""
    high, low, others, plain, _ = parts_of(seconds)
    exact = half_up(_exact_sum(high, low), F.lit(60).cast("decimal(19,0)")) / F.lit(100.0)
    return F.when(others == 0, exact).otherwise(F.round(plain / F.lit(60.0), 2))
