"""Output files: how many, in what order, and whether stored order holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.catalog.measuring import MINUTES_SQL, minutes_by_user
from eventloom.catalog.tables import CHUNKS_SQL, PLACE, chunk_root, table, version_roots
from eventloom.functions.sizing import files_for
from eventloom.operators.windows import out_of_order, overlapping
from eventloom.sources.inventory import file_profile, root_totals
from eventloom.sources.readers import read_root, with_row_place
from eventloom.sources.scratch import scratch_path
from eventloom.sources.writers import bytes_when_written, write_ordered, write_sized

OUT_FILES = 8


def write_roundtrip(spark, sf_dir):
    rows, out = minutes_by_user(spark, sf_dir), scratch_path(spark, "minutes-even")
    write_sized(rows, out, minimum=OUT_FILES, input_roots=[sf_dir])
    return read_root(spark, out, rows.schema)


def write_few_files(spark, sf_dir):
    rows, out = minutes_by_user(spark, sf_dir), scratch_path(spark, "minutes-few")
    write_sized(rows, out, minimum=OUT_FILES, even=False, input_roots=[sf_dir])
    return read_root(spark, out, rows.schema)


def write_range_layout(spark, sf_dir):
    rows, out = table(spark, sf_dir, "events"), scratch_path(spark, "events-ranged")
    files = files_for(bytes_when_written(rows), minimum=6)
    placed = with_row_place(rows)
    write_ordered(placed, out, files, ["ts", "event_id"], place=PLACE, input_roots=[sf_dir])
    return read_root(spark, out, rows.schema)


def _overlaps(place, number):
    ranges = place.groupBy("file_path").agg(
        F.min("ts").alias("low"), F.max("ts").alias("high"), F.count(F.lit(1)).alias("n")
    )
    ranges = ranges.withColumn("number", F.regexp_extract("file_path", number, 1).cast("bigint"))
    rows = ranges.agg(F.sum("n")).scalar()
    return overlapping(ranges, "number", "low", "high").select(rows.alias("rows"), "overlaps")


def range_files(spark, sf_dir):
    """Files whose time range overlaps that of the file above, in three layouts: the time-ordered
    version (part names rise with the range), neighbouring event ids, and event ids dealt out."""
    path, _ = version_roots(spark, sf_dir)["v1"]
    place = with_row_place(read_root(spark, path).select(F.col("event_timestamp").alias("ts"), "_metadata"))
    found = [_overlaps(place, r"part-(\d+)").withColumn("layout", F.lit("ordered"))]
    for layout in ("ranged", "dealt"):
        place = with_row_place(read_root(spark, chunk_root(spark, sf_dir, layout)).select("ts", "_metadata"))
        found.append(_overlaps(place, r"chunk=(\d+)").withColumn("layout", F.lit(layout)))
    return reduce(DataFrame.unionByName, found)


def stored_order(spark, sf_dir):
    rows = with_row_place(table(spark, sf_dir, "events"))
    return out_of_order(rows, "ts").agg(
        F.sum("rows").alias("rows"), F.sum("out_of_order").alias("out_of_order")
    )


def stored_order_by_value(spark, sf_dir):
    """Stored rows whose account balance is below the customer stored before."""
    rows = with_row_place(table(spark, sf_dir, "customer"))
    return out_of_order(rows, "c_acctbal", block_rows=100).agg(
        F.sum("rows").alias("rows"), F.sum("out_of_order").alias("out_of_order")
    )


def version_files(spark, sf_dir):
    """Rows in the files of each version, from the footers, and over both."""
    roots = {name: path for name, (path, _) in version_roots(spark, sf_dir).items()}
    return root_totals(file_profile(spark, roots)).select("root", "rows")


QUERIES = {
    "q_write_roundtrip": write_roundtrip,
    "q_write_coalesced": write_few_files,
    "q_write_range_layout": write_range_layout,
    "q_range_files": range_files,
    "q_out_of_order": stored_order,
    "q_out_of_order_values": stored_order_by_value,
    "q_version_files": version_files,
}

SQL = {
    "q_write_roundtrip": MINUTES_SQL,
    "q_write_coalesced": MINUTES_SQL,
    "q_write_range_layout": "select * from events",
    "q_range_files": f"""with {CHUNKS_SQL},
        v1 as (select *, lag(ts) over (order by ts, event_id) as above from events
               where event_id * 2 < (select count(*) from events)),
        f as (select 'ranged' as layout, chunk, min(ts) as low, max(ts) as high, count(*) as n from ranged group by chunk
              union all select 'dealt', chunk, min(ts), max(ts), count(*) from dealt group by chunk),
        o as (select *, lag(high) over (partition by layout order by chunk) as above from f)
        select 'ordered' as layout, count(*) as rows, count(*) filter (ts < above) as overlaps from v1
        union all
        select layout, cast(sum(n) as bigint), count(*) filter (low < above) from o group by layout""",
    "q_out_of_order": """select count(*) as rows, count(*) filter (ts < above) as out_of_order
        from (select ts, lag(ts) over (order by event_id) as above from events)""",
    "q_out_of_order_values": """select count(*) as rows, count(*) filter (c_acctbal < above) as out_of_order
        from (select c_acctbal, lag(c_acctbal) over (order by c_custkey) as above from customer)""",
    "q_version_files": """with v as (
          select case when event_id * 2 < (select count(*) from events) then 'v1' else 'v2' end as root from events)
        select root, count(*) as rows from v group by root union all select 'all', count(*) from v""",
}
