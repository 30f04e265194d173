"""One place that sets the session options, so none can be mis-spelt."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "eventloom",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC time and adaptive execution.

    On a cluster leave ``master`` unset and give ``shuffle_partitions`` as the
    largest number of reduce tasks a job may need (input bytes / 128 MB, say);
    adaptive execution merges the ones that turn out small.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # nanosecond Parquet timestamps arrive as numbers, see sources.readers.nanos_as_time
        .config("spark.sql.legacy.parquet.nanosAsLong", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
