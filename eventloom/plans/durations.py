"""Mean durations over event and profile columns, top groups, and minutes per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.exact import PARTS, exact_mean, exact_minutes, mean_from, parts_again, parts_of
from eventloom.functions.sizing import MAX_BROADCAST_BYTES, fits_broadcast
from eventloom.operators.layout import kept
from eventloom.operators.windows import top_per_group
from eventloom.sources.readers import read_root
from eventloom.sources.scratch import scratch_path
from eventloom.sources.writers import write_table

MEAN = "total_avg_duration"


def mean_duration(
    events: DataFrame,
    profile: DataFrame,
    keys: Sequence[str],
    *,
    on: str = "user_id",
    value: str = "duration_seconds",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Mean duration by keys of either table, for events that have a profile.

    A profile within ``max_bytes`` is broadcast and the events are aggregated
    as they are read. For a larger one the events are first summed per user
    and event key, which happens before the shuffle and takes the weight out of
    a user with very many events; only those sums are joined.
    """
    event_keys = [k for k in keys if k in events.columns and k != on]
    profile_keys = [k for k in keys if k not in event_keys and k != on]
    narrow = events.select(on, *event_keys, value)
    side = profile.select(on, *profile_keys)
    if fits_broadcast(side, max_bytes):
        joined, parts = narrow.join(F.broadcast(side), on), parts_of(F.col(value))
    else:
        joined, parts = narrow.groupBy(on, *event_keys).agg(*parts_of(F.col(value))).join(side, on), parts_again()
    sums = joined.groupBy(*keys).agg(*parts)
    return sums.select(*keys, mean_from(*[F.col(p) for p in PARTS]).alias(MEAN))


def top_groups(means: DataFrame, group: str, n: int = 5) -> DataFrame:
    """The ``n`` largest means per group, ties by the other keys."""
    ties = [c for c in means.columns if c not in (group, MEAN)]
    return top_per_group(means, group, MEAN, n, ties)


def mean_of_means(means: DataFrame, key: str, name: str = "mean_of_group_means") -> DataFrame:
    """Unweighted mean of already rounded group means."""
    return means.groupBy(key).agg(exact_mean(F.col(MEAN)).alias(name))


def weighted_mean(events: DataFrame, profile: DataFrame, key: str, **options) -> DataFrame:
    """Mean over all rows of a key, which the mean of group means is not."""
    return mean_duration(events, profile, [key], **options).withColumnRenamed(MEAN, "row_mean")


def duration_report(
    events: DataFrame, profile: DataFrame, *, group: str = "device_type", key: str = "user_segment", n: int = 5
) -> DataFrame:
    """Top groups and mean of means from one aggregate, computed once.

    Only the small aggregate is kept in memory, and it is released before this
    returns: both results are written to the shared scratch folder and read back.
    """
    spark = events.sparkSession
    means = mean_duration(events, profile, ["country", group, key])
    out = scratch_path(spark, "duration-report")
    with kept(means) as held:
        top = top_groups(held, group, n).select(
            F.lit("top").alias("part"), "country", group, key, F.col(MEAN).alias("value")
        )
        overall = mean_of_means(held, key, "value").select(
            F.lit("mean").alias("part"),
            F.lit(None).cast("string").alias("country"),
            F.lit(None).cast("string").alias(group),
            key,
            "value",
        )
        write_table(top.unionByName(overall), out)
    return read_root(spark, out)


def minutes_per_user(
    events: DataFrame,
    *,
    user: str = "user_id",
    value: str = "duration_seconds",
    name: str = "total_duration_minutes",
) -> DataFrame:
    """Summed duration per user in minutes, as text; null when a user has none."""
    return events.groupBy(user).agg(exact_minutes(F.col(value)).cast("string").alias(name))
