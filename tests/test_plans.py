"""The physical plans the library promises."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from eventloom.catalog import all_queries
from eventloom.operators.joins import enrich


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_enrichment_strategies(spark, sf_dir, no_auto_broadcast):
    q = queries()
    assert "SortMergeJoin" in plan(q["q_enrich_rows_shuffle"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan(q["q_enrich_rows"](spark, sf_dir))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    users = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"))
    too_big = plan(enrich(events, users, "user_id", strategy="broadcast", max_bytes=10))
    assert "SortMergeJoin" in too_big and "Broadcast" not in too_big
    with pytest.raises(ValueError):
        enrich(events, users, "user_id", strategy="nested")


def test_first_rows_need_no_full_sort(spark, sf_dir):
    for name in ("q_enrich_shuffle", "q_enrich_broadcast"):
        assert "TakeOrderedAndProject" in plan(queries()[name](spark, sf_dir))


def test_top_groups_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(queries()["q_topk_per_device"](spark, sf_dir))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_flagship_reads_only_what_it_uses(spark, sf_dir):
    text = plan(queries()["q_topk_per_device"](spark, sf_dir))
    assert "props" not in text and "c_acctbal" not in text and "c_name" not in text
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_large_profile_is_joined_after_summing(spark, sf_dir, no_auto_broadcast):
    text = plan(queries()["q_avg_by_three_keys_large_profile"](spark, sf_dir))
    join = text.index("SortMergeJoin")
    assert "partial_sum" in text[join:] and "HashAggregate" in text[:join]


def test_bursts_shuffle_once(spark, sf_dir):
    text = plan(queries()["q_burst_users"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_rows_no_cross_joins(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert word not in text


def test_counts_filter_and_prune_at_the_scan(spark, sf_dir):
    text = plan(queries()["q_count_by_country"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint>" in text
    assert "partial_count" in text
