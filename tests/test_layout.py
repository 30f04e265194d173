"""Files and partitions: how many, in what order, and where output may go."""

import glob

import pytest
from pyspark.sql import functions as F

from eventloom.catalog import all_queries
from eventloom.functions.sizing import estimated_bytes, files_for, fits_broadcast, source_bytes
from eventloom.operators.layout import balance, job_label, kept, rows_in_place
from eventloom.sources.inventory import expect_files, file_profile, root_totals
from eventloom.sources.readers import read_part, with_row_place
from eventloom.sources.scratch import scratch_path, scratch_space
from eventloom.sources.writers import (
    bytes_when_written,
    check_target,
    stored_bytes,
    write_coalesced,
    write_ordered,
    write_repartitioned,
    write_sized,
    write_table,
)


def parts(path):
    return sorted(glob.glob(f"{path}/part-*.parquet"))


def test_repartition_writes_that_many_files(spark, tmp_path):
    out = str(tmp_path / "out")
    write_repartitioned(spark.range(1000), out, 8)
    assert len(parts(out)) == 8 and spark.read.parquet(out).count() == 1000
    assert parts(out)[0].endswith(".snappy.parquet")


def test_coalesce_never_adds_files(spark, tmp_path):
    three = spark.range(1000).repartition(3)
    write_coalesced(three, str(tmp_path / "a"), 8)
    write_coalesced(three, str(tmp_path / "b"), 2)
    assert len(parts(tmp_path / "a")) == 3 and len(parts(tmp_path / "b")) == 2


def test_ordered_files_hold_rising_ranges(spark, tmp_path):
    out = str(tmp_path / "out")
    # a third of the rows share one moment; the second column still cuts it
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("t"), "id")
    write_ordered(rows.orderBy(F.rand(3)), out, 6, ["t", "id"])
    files = parts(out)
    assert len(files) == 6
    last = None
    for f in files:
        held = [tuple(r) for r in spark.read.parquet(f).select("t", "id").collect()]
        assert held == sorted(held) and (last is None or held[0] > last)
        assert len(held) < 1000
        last = held[-1]


def test_copies_of_one_row_can_fill_several_files(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.range(3000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("t")).write.parquet(src)
    placed = with_row_place(spark.read.parquet(src))
    write_ordered(placed, out, 6, ["t"], place=["file_path", "row_index"])
    sizes = [spark.read.parquet(f).count() for f in parts(out)]
    assert sum(sizes) == 3000 and max(sizes) < 800
    assert spark.read.parquet(out).columns == ["t"]


def test_existing_target_is_refused_unless_overwritten(spark, tmp_path):
    out = str(tmp_path / "out")
    write_table(spark.range(3), out)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(spark.range(3), out)
    write_table(spark.range(5), out, overwrite=True)
    assert spark.read.parquet(out).count() == 5


@pytest.mark.parametrize(
    "target,root",
    [
        ("/data/events/out", "/data/events/*/"),
        ("/data/events/v1", "/data/events/v1/"),
        ("/data/events/v1/out", "file:///data/events/v1"),
        ("/data/events", "/data/events/v1"),
        ("hdfs://a/data/events//out", "hdfs://a/data/events/{v1,v2}"),
    ],
)
def test_output_among_inputs_is_refused(spark, target, root):
    with pytest.raises(ValueError):
        check_target(target, [root])


def test_output_beside_inputs_is_fine():
    check_target("/data/events_out", ["/data/events", "/data/events/*/"])
    check_target("/data/reports/out", ["/data/events/v1", "/data/events/v2"])


def test_rows_per_partition(spark):
    rows = [("US", i) for i in range(550)] + [(f"C{i % 47}", i) for i in range(450)] + [(None, 1)]
    placed = rows_in_place(spark.createDataFrame(rows, "country string, id int").repartition(8, "country"))
    row = balance(placed, 8).first()
    assert row["rows"] == 1001 and row["fullest"] >= 550 and row["used_partitions"] <= 8


def test_file_inventory(spark, tmp_path):
    roots = {"v1": str(tmp_path / "v1"), "v2": str(tmp_path / "v2")}
    write_repartitioned(spark.range(100), roots["v1"], 4)
    write_repartitioned(spark.range(50), roots["v2"], 2)
    files = file_profile(spark, roots)
    totals = {r["root"]: r for r in root_totals(files).collect()}
    assert {k: (r["files"], r["rows"]) for k, r in totals.items()} == {"v1": (4, 100), "v2": (2, 50), "all": (6, 150)}
    assert totals["all"]["bytes"] == totals["v1"]["bytes"] + totals["v2"]["bytes"] > 0
    checked = {r["root"]: r["files_ok"] for r in expect_files(root_totals(files), {"v1": 4, "v2": 3}).collect()}
    assert checked == {"v1": True, "v2": False, "all": None}
    name = parts(roots["v1"])[0].rsplit("/", 1)[1]
    assert read_part(spark, roots["v1"], name).count() == 25


def test_scratch_follows_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    if before:
        assert path.startswith(before)


def test_a_space_deletes_what_it_owns(spark, sf_dir, tmp_path):
    with scratch_space(spark, str(tmp_path)) as space:
        assert scratch_path(spark, "x").startswith(str(tmp_path))
        for name in ("q_write_range_layout", "q_duration_report", "q_evolve_counts", "q_version_files"):
            assert all_queries()[name](spark, sf_dir).count() > 0
        assert glob.glob(f"{space.root}/*") and sf_dir in space.kept
    assert not glob.glob(f"{tmp_path}/eventloom/*") and not space.kept
    assert not scratch_path(spark, "x").startswith(str(tmp_path))


def test_sizes(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert 0 < estimated_bytes(events.select("user_id")) < estimated_bytes(events)
    assert fits_broadcast(events) and not fits_broadcast(events, 10)
    assert files_for(5) == 1 and files_for(5, minimum=4) == 4 and files_for(10_000, 1000) == 10


def test_unknown_and_multiplied_sizes(spark, sf_dir):
    # a table from an RDD has no size; a join has at most the tables it reads
    loose = spark.createDataFrame(spark.sparkContext.parallelize([(i,) for i in range(10)]), "id int")
    assert estimated_bytes(loose) is None and source_bytes(loose) is None and not fits_broadcast(loose)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    joined = events.join(events.withColumnRenamed("event_id", "other"), "user_id")
    assert source_bytes(joined) <= 2 * stored_bytes(spark, f"{sf_dir}/events.parquet") < estimated_bytes(joined)


def test_files_follow_written_bytes(spark, tmp_path):
    # Catalyst thinks this table as large as its source; its one row needs one file
    rows = spark.range(2_000_000).select(F.sha2(F.col("id").cast("string"), 256).alias("s"))
    total = rows.groupBy(F.length("s").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    assert write_sized(total, str(tmp_path / "total"), target_bytes=10_000) == 1
    some = rows.limit(20_000)
    asked = write_sized(some, str(tmp_path / "even"), target_bytes=100_000)
    size = stored_bytes(spark, str(tmp_path / "even"))
    assert len(parts(tmp_path / "even")) == asked and 0.5 < size / asked / 100_000 < 1.5
    few = write_sized(some, str(tmp_path / "few"), target_bytes=600_000, even=False)
    assert len(parts(tmp_path / "few")) <= few <= 5
    assert bag_of(spark, tmp_path / "few") == bag_of(spark, tmp_path / "even") == 20_000


def bag_of(spark, path):
    return spark.read.parquet(str(path)).distinct().count()


def test_bytes_from_a_sample(spark, tmp_path):
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("s"))
    rows.write.parquet(str(tmp_path / "all"))
    whole = spark.read.parquet(str(tmp_path / "all"))
    real = stored_bytes(spark, str(tmp_path / "all"))
    assert 0.8 < bytes_when_written(whole, 20_000) / real < 1.2
    assert 0.9 < bytes_when_written(whole) / real < 1.1
    assert bytes_when_written(whole.limit(0)) == 0


def test_kept_table_is_released(spark):
    df = spark.range(10)
    with kept(df) as held, job_label(df, "fill"):
        assert held.storageLevel.useMemory and held.count() == 10
    assert not df.storageLevel.useMemory
