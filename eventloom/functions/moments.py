"""Time arithmetic on zoneless timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gap_seconds(later: Column, earlier: Column) -> Column:
    """Difference of the two whole-second clocks: 1.9 s after x.5 may count as 2."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def time_bucket(moment: Column, origin: str, width_seconds: int) -> Column:
    """Number of the fixed-width bucket a moment falls in, counted from ``origin``."""
    start = F.unix_timestamp(F.lit(origin).cast("timestamp_ntz"))
    return F.floor((F.unix_timestamp(moment) - start) / F.lit(width_seconds)).cast("bigint")


def from_epoch(seconds: Column, origin: str) -> Column:
    """``origin`` plus a number of seconds, as a zoneless timestamp."""
    return F.lit(origin).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def plus_days(origin: str, days: Column) -> Column:
    """A calendar date plus a number of days."""
    return F.date_add(F.lit(origin).cast("date"), days.cast("int"))
