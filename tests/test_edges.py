"""Hand-made tables: nulls, ties, sub-second gaps, conflicting and growing schemas."""

import datetime
import random

import pyarrow.parquet as pq
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from eventloom.functions.assign import null_where, padded_id, pick_uniform, pick_weighted
from eventloom.functions.exact import exact_mean, exact_minutes
from eventloom.functions.salt import label_part, salt_label
from eventloom.operators.aggregates import expected_vs_actual, share_of_rows, skew_profile
from eventloom.operators.evolution import column_changes, only_adds
from eventloom.operators.joins import key_coverage, only_listed
from eventloom.operators.quality import quality_report, size_report
from eventloom.operators.sets import rows_outside, unknown_values
from eventloom.operators.windows import out_of_order, overlapping, top_per_group, with_gaps
from eventloom.plans.bursts import burst_users, gap_events, gaps_by_file
from eventloom.plans.durations import mean_duration, mean_of_means, minutes_per_user, weighted_mean
from eventloom.sources.footers import column_inventory, files_that_differ, schema_changes
from eventloom.sources.inventory import file_profile
from eventloom.sources.readers import read_merged, read_unmerged, read_versions, union_versions, with_row_place
from eventloom.sources.schemas import EVENTS_V1, EVENTS_V2

T0 = datetime.datetime(2024, 1, 1)


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


# ---- gaps --------------------------------------------------------------------


def test_gap_edges(spark):
    rows = [
        (1, at(0)), (1, at(0)), (1, at(2)), (1, at(5)),  # equal moments, gaps 2 and 3
        (2, at(10)),  # a single event
        (3, at(0.5)), (3, at(2.4)), (3, at(4.5)),  # 1.9 s and 2.1 s apart
    ]
    df = spark.createDataFrame(rows, "user_id bigint, event_timestamp timestamp_ntz")
    gaps = {
        (r["user_id"], r["event_timestamp"], r["gap_seconds"])
        for r in with_gaps(df, "user_id", "event_timestamp").collect()
    }
    assert gaps == {
        (1, at(0), None), (1, at(0), 0), (1, at(2), 2), (1, at(5), 3), (2, at(10), None),
        # whole-second clocks: 2 - 0 and 4 - 2
        (3, at(0.5), None), (3, at(2.4), 2), (3, at(4.5), 2),
    }
    assert gap_events(df).count() == 4
    found = {r["user_id"]: r["total_count"] for r in burst_users(df, more_than=1).collect()}
    assert found == {1: 2, 3: 2}


def test_default_burst_needs_more_than_ten_gaps(spark):
    rows = [(u, at(i)) for u, n in ((1, 11), (2, 12)) for i in range(n)]
    df = spark.createDataFrame(rows, "user_id bigint, event_timestamp timestamp_ntz")
    assert [tuple(r) for r in burst_users(df).collect()] == [(2, 11)]


def test_gap_does_not_depend_on_session_zone(spark):
    df = spark.createDataFrame(
        [(1, datetime.datetime(2024, 3, 10, 1, 59, 59)), (1, datetime.datetime(2024, 3, 10, 3, 0, 1))],
        "user_id bigint, event_timestamp timestamp_ntz",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = with_gaps(df, "user_id", "event_timestamp").agg(F.max("gap_seconds")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == 3602


# ---- durations ---------------------------------------------------------------


def test_user_without_durations(spark):
    rows = [(1, None), (1, None), (2, 90.0), (2, None), (3, 0.3)]
    df = spark.createDataFrame(rows, "user_id bigint, duration_seconds double")
    minutes = {r[0]: r[1] for r in minutes_per_user(df).collect()}
    assert minutes == {1: None, 2: "1.5", 3: "0.01"}
    means = df.groupBy("user_id").agg(exact_mean(F.col("duration_seconds")).alias("m"))
    assert {r[0]: r[1] for r in means.collect()} == {1: None, 2: 90.0, 3: 0.3}


@pytest.mark.parametrize(
    "values,want", [([0.01, 0.02], 0.02), ([-0.01, -0.02], -0.02), ([1.0, 1.01, 1.01], 1.01), ([0.1] * 7, 0.1)]
)
def test_means_round_half_away_from_zero(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert df.agg(exact_mean(F.col("x"))).first()[0] == want


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    "values",
    [[0.006, 0.006, 0.0], [1.234, 5.678, None], [NAN, 10.0], [INF, 1.0], [-INF, 1.0], [INF, -INF], [-0.006, -0.129], [1e300, 2.0], [0.125], [-2.5, 7.25]],
)
def test_means_and_minutes_beyond_two_decimals(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(exact_mean(F.col("x")), exact_minutes(F.col("x"))).first()
    want = df.agg(F.round(F.avg("x"), 2), F.round(F.sum("x") / 60, 2)).first()
    assert [str(v) for v in got] == [str(v) for v in want]


def test_split_means_beyond_two_decimals(spark):
    events = spark.createDataFrame([(1, "US", 0.006), (1, "US", 0.006), (2, "US", 0.0), (2, "UK", NAN), (1, "UK", 2.0)], "user_id bigint, country string, duration_seconds double")
    users = spark.createDataFrame([(1, "a"), (2, "a")], "user_id bigint, user_segment string")
    for max_bytes in (0, 10**9):
        got = {r["country"]: str(r["total_avg_duration"]) for r in mean_duration(events, users, ["country"], max_bytes=max_bytes).collect()}
        assert got == {"US": "0.0", "UK": "nan"}


def test_minutes_round_half_up(spark):
    # 0.3 s is 0.005 min
    assert spark.sql("select 0.3D as x").agg(exact_minutes(F.col("x"))).first()[0] == 0.01


def test_wide_and_narrow_profile_plans_agree(spark):
    events = spark.createDataFrame(
        [(1, "US", 1.0), (1, "US", 2.0), (2, "US", 4.5), (2, "UK", None), (9, "UK", 3.0)],
        "user_id bigint, country string, duration_seconds double",
    )
    users = spark.createDataFrame([(1, "a"), (2, "b")], "user_id bigint, user_segment string")
    for max_bytes in (0, 10**9):
        got = mean_duration(events, users, ["country", "user_segment"], max_bytes=max_bytes)
        assert {tuple(r) for r in got.collect()} == {("US", "a", 1.5), ("US", "b", 4.5), ("UK", "b", None)}
    means = mean_duration(events, users, ["country", "user_segment"])
    assert {tuple(r) for r in mean_of_means(means, "country").collect()} == {("US", 3.0), ("UK", None)}
    assert {tuple(r) for r in weighted_mean(events, users, "country").collect()} == {("US", 2.5), ("UK", None)}


def test_top_groups_with_ties_and_nulls(spark):
    rows = [("a", k, 1.0) for k in "zyxwvut"] + [("a", "n", None), ("b", "n", None), ("b", "m", 0.5)]
    df = spark.createDataFrame(rows, "g string, k string, v double")
    got = {(r["g"], r["k"], r["rn"]) for r in top_per_group(df, "g", "v", 5, ["k"]).collect()}
    assert got == {("a", k, i + 1) for i, k in enumerate("tuvwx")} | {("b", "m", 1), ("b", "n", 2)}


# ---- order of stored rows ----------------------------------------------------


def test_out_of_order_rows_per_file(spark, tmp_path):
    files = [[0, 5, 3, 9], [8, 1, 2, 7]]
    for i, seconds in enumerate(files):
        rows = [(j, at(s)) for j, s in enumerate(seconds)]
        one = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz").coalesce(1)
        one.write.parquet(str(tmp_path / f"f{i}"))
    df = with_row_place(spark.read.parquet(str(tmp_path / "f0"), str(tmp_path / "f1")))
    for block in (1, 2, 3, 1000):
        got = [tuple(r)[1:] for r in out_of_order(df, "ts", block_rows=block).collect()]
        # the step down from one file to the next is not counted
        assert got == [(4, 1), (4, 1)], block


# ---- schemas that grow -------------------------------------------------------


@pytest.fixture
def grown(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id bigint, k string, v double").write.parquet(old)
    spark.createDataFrame(
        [(3, "c", 3.0, None, "on"), (4, "d", 4.0, "x", "off")],
        "id bigint, k string, v double, grp string, flag string",
    ).write.parquet(new)
    return old, new


def test_merged_read_equals_union_by_name(spark, grown):
    merged, union = read_merged(spark, *grown), read_versions(spark, grown)
    assert merged.columns == union.columns == ["id", "k", "v", "grp", "flag"]
    assert sorted(map(str, merged.collect())) == sorted(map(str, union.collect()))
    assert {r["id"] for r in merged.where("grp is null").collect()} == {1, 2, 3}


def test_plain_read_misses_the_new_columns(spark, grown):
    plain = read_unmerged(spark, *grown)
    assert plain.count() == 4 and "grp" not in plain.columns
    with pytest.raises(AnalysisException):
        plain.select("grp")


def test_conflicting_types_are_refused(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    spark.sql("select 1L as user_id").write.parquet(old)
    spark.sql("select 'U1' as user_id").write.parquet(new)
    with pytest.raises((PySparkException, Py4JJavaError), match="CANNOT_MERGE_SCHEMAS"):
        read_merged(spark, old, new).collect()
    with pytest.raises(ValueError):
        read_versions(spark, [old, new])


def test_union_of_nothing_is_refused():
    with pytest.raises(ValueError):
        union_versions([])


def test_column_changes():
    added = [c for c in column_changes(EVENTS_V1, EVENTS_V2) if c[1] != "same"]
    assert added == [("ab_test_group", "added", None, "string"), ("feature_flag", "added", None, "string")]
    assert only_adds(EVENTS_V1, EVENTS_V2, ["feature_flag", "ab_test_group"])
    assert not only_adds(EVENTS_V1, EVENTS_V2, ["feature_flag"])
    assert not only_adds(EVENTS_V2, EVENTS_V1, [])
    assert len(EVENTS_V1) == 11 and len(EVENTS_V2) == 13


# ---- small functions ---------------------------------------------------------


def test_assignments(spark):
    df = spark.range(100_000)
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    shares = df.select(pick_weighted(draw, {"a": 0.55, "b": 0.35, "c": 0.10}).alias("x")).groupBy("x").count()
    found = {r["x"]: r["count"] / 100_000 for r in shares.collect()}
    assert abs(found["a"] - 0.55) < 0.01 and abs(found["c"] - 0.10) < 0.01
    assert df.agg(F.min(draw) >= 0, F.max(draw) < 1).first()[:] == (True, True)
    row = spark.range(1).select(
        padded_id("E", F.lit(42), 10),
        padded_id("E", F.lit(12345678901), 10),
        pick_uniform(F.lit(-1), ["x", "y", "z"]),
        pick_weighted(F.lit(0.99), {"only": 1.0}),
        null_where(F.lit(None).cast("boolean"), F.lit(5)),
        null_where(F.lit(True), F.lit(5)),
    )
    assert tuple(row.first()) == ("E0000000042", "E12345678901", "z", "only", 5, None)


def test_salt_label(spark):
    row = spark.range(1).select(
        salt_label(F.lit("US"), F.lit(3)),
        salt_label(F.lit(None).cast("string"), F.lit(3)),
        label_part(F.lit("US_3"), "_", 0),
    )
    assert tuple(row.first()) == ("US_3", None, "US")


def test_skew_profile_ties_and_nulls(spark):
    rows = [("b",)] * 3 + [("a",)] * 3 + [("d",)] + [("c",)] + [(None,)] * 9
    got = skew_profile(spark.createDataFrame(rows, "k string"), "k").first()
    assert tuple(got) == (4, "a", 3, "c", 1, 3)


def test_expected_rows_round_down_and_show_missing_keys(spark):
    df = spark.createDataFrame([("a",)] * 7, "k string")
    weights = spark.createDataFrame([("a", 0.55), ("z", 0.10)], "k string, weight double")
    assert {tuple(r) for r in expected_vs_actual(df, "k", weights).collect()} == {("a", 3, 7), ("z", 0, 0)}


def test_share_of_no_rows_is_unknown(spark):
    assert spark.range(0).agg(share_of_rows(F.col("id") > 1)).first()[0] is None


def test_coverage_and_lists(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (1,), (7,), (None,)], "k int")
    assert tuple(key_coverage(fact, dim, "k").first()) == (2, 1, 50.0)
    for max_bytes in (0, 10**15):
        assert only_listed(fact, dim, "k", max_bytes=max_bytes).count() == 2


def test_domains(spark):
    df = spark.createDataFrame([("3.0",), ("4.2",), ("4.2",), (None,)], "app string")
    assert {tuple(r) for r in rows_outside(df, "app", ["3.0"]).collect()} == {("4.2", 2), (None, 1)}
    allowed = spark.createDataFrame([("3.0",), (None,)], "app string")
    assert [r[0] for r in unknown_values(df, allowed, "app").collect()] == ["4.2"]


def test_missing_key_is_no_key(spark):
    rows = [("US", "click", None)] * 200 + [("IN", "purchase", 1.0)] * 100 + [(None, "view", 1.0)]
    df = spark.createDataFrame(rows, "country string, event_type string, duration_seconds double")
    got = {r["check"]: (r["value"], r["passed"]) for r in quality_report(df, key="country", weights={"a": 1.0}).collect()}
    assert got["skew_ratio"] == (2.0, False) == (float(skew_profile(df, "country").first()["ratio"]), False)
    assert got["top_share_pct"] == (99.7, True) and not got["skew_status"][1] and not got["partition_ratio"][1]


def test_stored_bytes_are_the_files_bytes(spark, tmp_path):
    root = str(tmp_path / "dim")
    spark.range(1000).repartition(3).write.parquet(root)
    files = file_profile(spark, {"dim": root})
    size = sum(f.stat().st_size for f in (tmp_path / "dim").glob("part-*.parquet"))
    for limit, passed in ((size, False), (size + 1, True)):
        row = size_report(files, column_inventory(spark, root), ["id"], max_dimension_bytes=limit).where("check = 'dimension_bytes'").first()
        assert (row["value"], row["passed"]) == (float(size), passed)


def test_narrow_bytes_are_those_of_the_column_chunks(spark, tmp_path):
    root = str(tmp_path / "wide")
    wide = spark.range(5000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), F.struct("id").alias("n"))
    wide.repartition(3).write.parquet(root)
    plain, stored = {}, {}
    for f in (tmp_path / "wide").glob("part-*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for i in range(meta.num_columns):
                chunk = meta.row_group(g).column(i)
                name = chunk.path_in_schema.split(".")[0]
                plain[name] = plain.get(name, 0) + chunk.total_uncompressed_size
                stored[name] = stored.get(name, 0) + chunk.total_compressed_size
    columns = column_inventory(spark, root)
    got = {r[0]: (r[1], r[2]) for r in columns.groupBy("column_name").agg(F.sum("plain_bytes"), F.sum("stored_bytes")).collect()}
    assert got == {name: (plain[name], stored[name]) for name in ("id", "s", "n")}
    files = file_profile(spark, {"wide": root})
    row = size_report(files, columns, ["id"], 0.5).where("check = 'narrow_bytes'").first()
    assert (row["value"], row["threshold"], row["passed"]) == (int(plain["id"] / 2 + 0.5), sum(plain.values()), True)
    assert not size_report(files, columns, ["id", "s", "n"]).where("check = 'narrow_bytes'").first()["passed"]
    assert not size_report(files, columns.limit(0), ["id"]).where("check = 'narrow_bytes'").first()["passed"]


def test_columns_that_appear_vanish_or_change(spark, tmp_path):
    root = str(tmp_path / "grown")
    for i, names in enumerate((["a bigint", "b double"], ["a bigint", "b double", "c string"], ["a string", "c string"])):
        spark.createDataFrame([(None,) * len(names)] * (10 + i), ", ".join(names)).coalesce(1).write.parquet(f"{root}/{i}")
    found = column_inventory(spark, root)
    got = {(r["column_name"], r["type"]): (r["files"], r["rows"], r["all_files"], r["all_rows"], r["change"]) for r in schema_changes(found).collect()}
    assert got == {
        ("a", "int64"): (2, 21, 3, 33, "retyped"),
        ("a", "string"): (1, 12, 3, 33, "retyped"),
        ("b", "double"): (2, 21, 3, 33, "partial"),
        ("c", "string"): (2, 23, 3, 33, "partial"),
    }
    odd = {(r["file_path"].split("/")[-2], r["column_name"]): (r["type"], r["usual_type"]) for r in files_that_differ(found).collect()}
    assert odd == {("0", "c"): (None, "string"), ("2", "a"): ("string", "int64"), ("2", "b"): (None, "double")}


def test_footers_of_a_store_only_spark_can_open(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    spark.range(100).repartition(2).write.parquet(root)
    want = sorted(tuple(r) for r in column_inventory(spark, root).collect())
    monkeypatch.setattr("eventloom.sources.footers.RANGED", ())
    assert sorted(tuple(r) for r in column_inventory(spark, root).collect()) == want and len(want) == 2


def test_sums_beyond_a_bigint(spark):
    df = spark.range(10_000).select(F.lit(9e12).alias("x"), (F.lit(-9e12) - F.lit(0.01)).alias("y"))
    assert tuple(df.agg(exact_mean(F.col("x")), exact_mean(F.col("y"))).first()) == (9e12, -9000000000000.01)
    assert df.agg(exact_minutes(F.col("x"))).first()[0] == 1.5e15


def test_gaps_inside_each_file(spark, tmp_path):
    rng = random.Random(2)
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, rng.randrange(4), start + datetime.timedelta(milliseconds=rng.randrange(400_000))) for i in range(600)]
    for part in range(3):
        spark.createDataFrame(rows[part * 200 : part * 200 + 200], "event_id bigint, user_id bigint, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/e/{part}")
    spark.createDataFrame([(9, 9, start)], "event_id bigint, user_id bigint, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/e/9")
    events = with_row_place(spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/e"))
    want = {"9": (1, 0, 0, False)}
    for part in range(3):
        mine = [(u, t) for _, u, t in rows[part * 200 : part * 200 + 200] if u in (0, 1)]
        tight = 0
        for user in (0, 1):
            times = sorted(t for u, t in mine if u == user)
            tight += sum(int((b.replace(microsecond=0) - a.replace(microsecond=0)).total_seconds()) < 3 for a, b in zip(times, times[1:]))
        want[str(part)] = (200, len(mine), tight, tight > 60)
    watched = spark.createDataFrame([(0,), (1,)], "user_id bigint")
    for place in (None, ["file_path", "row_index"]):
        found = gaps_by_file(events, watched, more_than=60, time="ts", spread_by=place).collect()
        assert {r["file_path"].split("/")[-2]: (r["rows"], r["watched_rows"], r["tight_gaps"], r["passed"]) for r in found} == want
    assert any(v[3] for v in want.values()) or max(v[2] for v in want.values()) > 0


@pytest.mark.parametrize("block", [1, 3, 100])
def test_overlapping_ranges(spark, block):
    ranges = [(0, 0, 5), (1, 5, 9), (2, 8, 12), (3, 20, 21), (4, 3, 4), (5, 4, 9)]
    row = overlapping(spark.createDataFrame(ranges, "i bigint, lo int, hi int"), "i", "lo", "hi", block=block).first()
    assert tuple(row) == (6, 2)


def test_quality_report_fails_bad_data(spark):
    rows = [("US", "click", 1.0), ("UK", "view", None)]
    df = spark.createDataFrame(rows, "country string, event_type string, duration_seconds double")
    got = {r["check"]: r["passed"] for r in quality_report(df, key="country", weights={"a": 0.4}).collect()}
    assert got["top_share_pct"] is True
    assert not any(v for k, v in got.items() if k != "top_share_pct")
