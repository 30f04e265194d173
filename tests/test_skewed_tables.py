"""Registered queries against their SQL on events where one user holds 40 % of
the rows and a quarter of those share one moment."""

import shutil

import pytest
from compare import duck_bag, spark_bag
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from eventloom.catalog.bursting import _events
from eventloom.functions.hotkeys import find_hot_keys

NAMES = [
    "q_avg_by_three_keys", "q_avg_by_three_keys_large_profile", "q_burst_users", "q_burst_users_tight",
    "q_enrich_rows_shuffle", "q_gap_events", "q_hot_key_join_rows", "q_minutes_by_user", "q_power_tier",
    "q_running_anchor", "q_topk_per_device", "q_user_event_count", "q_watchlist_gaps", "q_watchlist_semi",
]


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    source, out = "/root/testdata/sf0.01", str(tmp_path_factory.mktemp("skewed"))
    n = F.col("event_id")
    hot = n * 7919 % 10 < 4
    events = spark.read.parquet(f"{source}/events.parquet").withColumns(
        {
            "user_id": F.when(hot, F.lit(7)).otherwise(F.col("user_id")).cast("bigint"),
            "ts": F.when(hot & (n % 4 == 0), F.lit("2024-01-05 05:05:05").cast("timestamp_ntz")).otherwise(F.col("ts")),
        }
    )
    events.repartition(3).write.parquet(f"{out}/events.parquet")
    for name in ("customer", "nation", "documents", "labels", "part"):
        shutil.copyfile(f"{source}/{name}.parquet", f"{out}/{name}.parquet")
    return out


@pytest.fixture(params=["8", "64"])
def spread(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_user_is_hot(spark, skewed_dir, spread):
    assert find_hot_keys(_events(spark, skewed_dir), "user_id")


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_events(spark, skewed_dir, spread, name):
    names, rows = spark_bag(queries()[name](spark, skewed_dir))
    want_names, want, _ = duck_bag(oracle_sql()[name], skewed_dir)
    assert names == want_names and rows == want
