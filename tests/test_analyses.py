"""The six analyses on tables in the declared schemas, checked with pandas."""

import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventloom.catalog.assigning import build_events, build_profile
from eventloom.operators.aggregates import count_by, missing_counts, salted_aggregate
from eventloom.operators.joins import enrich, key_coverage
from eventloom.plans.bursts import burst_users, events_per_user, gap_report
from eventloom.plans.durations import mean_duration, mean_of_means, minutes_per_user, top_groups
from eventloom.plans.enrichment import first_enriched
from eventloom.plans.pairs import pairs_counted, pairs_hot_salted
from eventloom.sources.readers import nanos_as_time, read_merged, read_root, read_versions
from eventloom.sources.schemas import EVENTS_V1, EVENTS_V2, USER_PROFILE, conform
from eventloom.sources.writers import write_coalesced, write_ordered, write_repartitioned


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("activity"))
    events = build_events(spark, "/root/testdata/sf0.001")
    old = conform(events.where("event_id < 'E0000000500'"), EVENTS_V1)
    new = events.where("event_id >= 'E0000000500'")
    order = ["event_timestamp", "event_id"]
    write_ordered(old, f"{base}/events/v1", 3, order)
    write_ordered(new, f"{base}/events/v2", 3, order)
    write_repartitioned(build_profile(spark, "/root/testdata/sf0.001"), f"{base}/user_profile", 1)
    merged = pd.concat([old.toPandas(), new.toPandas()], ignore_index=True)
    return base, merged, read_root(spark, f"{base}/user_profile", USER_PROFILE).toPandas()


@pytest.fixture
def v1(spark, data):
    return read_root(spark, f"{data[0]}/events/v1", EVENTS_V1)


@pytest.fixture
def everything(spark, data):
    return read_merged(spark, f"{data[0]}/events/*/")


@pytest.fixture
def users(spark, data):
    return read_root(spark, f"{data[0]}/user_profile", USER_PROFILE)


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_skewed_counts_and_pairs(v1, everything, data):
    merged = data[1]
    want = merged[merged.event_id < "E0000000500"].country.value_counts().to_dict()
    assert as_dict(count_by(v1, "country")) == want
    salted = salted_aggregate(v1, ["country"], {"n": ("count", "*")}, buckets=10, spread_by=["event_id"])
    assert as_dict(salted) == want
    pairs = {k: n * n for k, n in merged.country.value_counts().items()}
    assert as_dict(pairs_counted(everything, "country")) == pairs
    assert as_dict(pairs_hot_salted(everything, "country", ["event_id"])) == pairs


def test_bursts(v1, data):
    merged = data[1]
    old = merged[merged.event_id < "E0000000500"].sort_values(["user_id", "event_timestamp"])
    assert as_dict(events_per_user(v1)) == old.groupby("user_id").size().to_dict()
    whole = old.event_timestamp.dt.floor("s")
    gap = whole.groupby(old.user_id).diff().dt.total_seconds()
    tight = old[gap <= 7200].groupby("user_id").size()
    assert gap_report(v1, max_gap=7200).count() == tight.sum()
    got = as_dict(burst_users(v1, max_gap=7200, more_than=1))
    assert got == tight[tight > 1].to_dict()


def test_enrichment(v1, users, data):
    merged, profile = data[1], data[2]
    old = merged[merged.event_id < "E0000000500"].merge(profile, on="user_id")
    for strategy in ("auto", "shuffle", "broadcast", "salted"):
        assert enrich(v1, users, "user_id", strategy=strategy).count() == len(old)
        first = first_enriched(v1, users, 5, ["user_id", "event_id"], strategy=strategy)
        want = old.sort_values(["user_id", "event_id"]).head(5)
        assert [r["event_id"] for r in first.collect()] == want.event_id.tolist()
    assert key_coverage(v1, users, "user_id").first()["coverage_pct"] == 100.0


def test_growing_schema(spark, everything, data):
    assert set(everything.columns) == set(EVENTS_V2.names) and everything.count() == len(data[1])
    got = missing_counts(everything, ["ab_test_group", "feature_flag"]).first()
    assert tuple(got) == (len(data[1]), 500, 500)
    assert as_dict(count_by(everything, "ab_test_group"))[None] == 500
    roots = [f"{data[0]}/events/v1", f"{data[0]}/events/v2"]
    declared = read_versions(spark, roots, [EVENTS_V1, EVENTS_V2])
    assert declared.exceptAll(everything.select(declared.columns)).count() == 0


def test_minutes_and_files(spark, everything, data, tmp_path):
    minutes = minutes_per_user(everything)
    globbed = f"{data[0]}/events/*/"
    with pytest.raises(ValueError):
        write_repartitioned(minutes, f"{data[0]}/events/output", 8, input_roots=[globbed], overwrite=True)
    write_repartitioned(minutes, f"{tmp_path}/even", 8, input_roots=[globbed])
    write_coalesced(minutes, f"{tmp_path}/few", 8, input_roots=[globbed])
    want = data[1].groupby("user_id").duration_seconds.sum(min_count=1)
    for name in ("even", "few"):
        got = as_dict(spark.read.parquet(f"{tmp_path}/{name}"))
        assert set(got) == set(want.index)
        for user, seconds in want.items():
            assert got[user] is None if pd.isna(seconds) else abs(float(got[user]) - seconds / 60) <= 0.00501


def test_durations(everything, users, data):
    joined = data[1].merge(data[2], on="user_id")
    keys = ["country", "device_type", "user_segment"]
    want = joined.groupby(keys).duration_seconds.mean()
    means = mean_duration(everything, users, keys)
    got = {(r[0], r[1], r[2]): r[3] for r in means.collect()}
    assert set(got) == set(want.index)
    for key, mean in want.items():
        assert got[key] is None if pd.isna(mean) else abs(got[key] - mean) <= 0.00501
    top = top_groups(means, "device_type").collect()
    for device in {k[1] for k in got}:
        best = sorted((v for k, v in got.items() if k[1] == device and v is not None), reverse=True)[:5]
        assert [r["total_avg_duration"] for r in sorted(top, key=lambda r: r["rn"]) if r["device_type"] == device] == best
    overall = pd.Series(got).groupby(level=2).mean()
    for segment, mean in as_dict(mean_of_means(means, "user_segment")).items():
        assert abs(mean - overall[segment]) <= 0.00501


def test_nanosecond_files(spark, tmp_path):
    moments = pd.Series([datetime.datetime(2024, 1, 1, 0, 0, 1), datetime.datetime(1969, 12, 31, 23, 59, 59)])
    table = pa.table({"id": [1, 2], "event_timestamp": pa.array(moments, pa.timestamp("ns"))})
    pq.write_table(table, tmp_path / "part_0000.parquet", version="2.6")
    df = nanos_as_time(read_root(spark, str(tmp_path)), "event_timestamp")
    assert dict(df.dtypes)["event_timestamp"] == "timestamp_ntz"
    assert as_dict(df) == {1: moments[0].to_pydatetime(), 2: moments[1].to_pydatetime()}
    assert nanos_as_time(df, "event_timestamp").agg(F.count("*")).first()[0] == 2
