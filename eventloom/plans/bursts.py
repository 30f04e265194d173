"""Users whose events follow each other too fast to be a person's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.moments import gap_seconds
from eventloom.operators.joins import only_listed
from eventloom.operators.windows import path_names, with_gaps, with_previous

MAX_GAP_SECONDS = 2
MORE_THAN = 10


def events_per_user(events: DataFrame, user: str = "user_id", time: str = "event_timestamp") -> DataFrame:
    """Events with a time per user, by user."""
    return events.groupBy(user).agg(F.count(time).alias("event_count")).orderBy(user)


def gap_events(
    events: DataFrame,
    *,
    max_gap: int = MAX_GAP_SECONDS,
    user: str = "user_id",
    time: str = "event_timestamp",
    spread_by: list[str] | None = None,
    keep: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Events at most ``max_gap`` seconds after the user's previous one.

    A user's first event has no gap and drops out. ``keep`` names further
    columns to carry along.
    """
    wanted = list(dict.fromkeys([user, time, *(spread_by or []), *keep]))
    gaps = with_gaps(events.select(*wanted), user, time, spread_by=spread_by, **options)
    return (
        gaps.dropna(subset=["gap_seconds"])
        .where(F.col("gap_seconds") <= max_gap)
        .select(user, time, "previous_timestamp", "gap_seconds", *keep)
    )


def gap_report(
    events: DataFrame,
    *,
    user: str = "user_id",
    time: str = "event_timestamp",
    spread_by: list[str] | None = None,
    **options,
) -> DataFrame:
    """``gap_events``, widest first.

    Sorted on all columns and the hash of ``spread_by``: the few distinct gaps,
    or one busy moment, would leave a sort on less with a few huge partitions.
    """
    order = [F.col("gap_seconds").desc(), F.col(user), F.col(time)]
    if not spread_by:
        return gap_events(events, user=user, time=time, **options).orderBy(*order)
    placed = events.withColumn("place_hash", F.xxhash64(*spread_by))
    found = gap_events(
        placed, user=user, time=time, spread_by=["place_hash"], keep=["place_hash"], **options
    )
    return found.orderBy(*order, "place_hash").drop("place_hash")


def burst_users(
    events: DataFrame, *, more_than: int = MORE_THAN, user: str = "user_id", **options
) -> DataFrame:
    """Users with more than ``more_than`` short gaps, and how many they have."""
    return (
        gap_events(events, user=user, **options)
        .groupBy(user)
        .agg(F.count("gap_seconds").alias("total_count"))
        .where(F.col("total_count") > more_than)
    )


def watchlist_gaps(
    events: DataFrame, watched: DataFrame, *, user: str = "user_id", **options
) -> DataFrame:
    """Short gaps per listed user."""
    return (
        gap_events(only_listed(events, watched, user), user=user, **options)
        .groupBy(user)
        .agg(F.count("gap_seconds").alias("tight_gaps"))
    )


def gaps_by_file(
    events: DataFrame,
    watched: DataFrame,
    *,
    below: int = MAX_GAP_SECONDS + 1,
    more_than: int = MORE_THAN,
    user: str = "user_id",
    time: str = "event_timestamp",
    file_column: str = "file_path",
    spread_by: list[str] | None = None,
) -> DataFrame:
    """One row per stored file: its rows, those of watched users, their gaps of less than
    ``below`` seconds inside the file, and whether there are more than ``more_than``.

    A gap does not reach over files. Rows are told apart by a hash of the path, and a hot user
    within a file is cut into slices.
    """
    rows = events.withColumn("file_key", F.xxhash64(file_column))
    every = rows.groupBy("file_key").agg(F.count(F.lit(1)).alias("rows"))
    wanted = list(dict.fromkeys(["file_key", user, time, *(spread_by or [])]))
    listed = only_listed(rows.select(*wanted), watched, user, spread_by=spread_by)
    seen = with_previous(listed, ["file_key", user], time, name="before", spread_by=spread_by)
    gaps = seen.groupBy("file_key").agg(
        F.count(F.lit(1)).alias("watched_rows"),
        F.count_if(gap_seconds(F.col(time), F.col("before")) < below).alias("tight_gaps"),
    )
    counted = every.join(gaps, "file_key", "left").fillna(0, ["watched_rows", "tight_gaps"])
    return counted.join(path_names(events, file_column), "file_key").select(
        file_column, "rows", "watched_rows", "tight_gaps", (F.col("tight_gaps") > more_than).alias("passed")
    )
