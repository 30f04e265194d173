"""The tables the queries run on, derived from the given Parquet files.

``activity`` stands for event data with a skewed country: fixed rules on the
event id give 50 countries (US 55 %, India 25 %, Brazil 10 %, 47 others) and
three devices. The same rules are stated as SQL at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.assign import null_where, pick_uniform, pick_weighted
from eventloom.functions.sizing import files_for
from eventloom.sources.readers import with_row_place
from eventloom.sources.scratch import current_space, scratch_path
from eventloom.sources.writers import bytes_when_written, write_ordered

# fixed values: app versions of both event versions, test groups and flags
V1_APPS = ("3.0", "3.1", "3.2", "3.5", "4.0", "4.1")
V2_APPS = ("4.2", "4.3", "4.5")
TEST_GROUPS = ("control", "variant_a", "variant_b")
FLAGS = ("enabled", "disabled")
EMPTY_KINDS = ("click", "error")
# fixed values: weights of the three heavy countries, and of the 47 others together
COUNTRY_WEIGHTS = {"US": 0.55, "India": 0.25, "Brazil": 0.10}
OTHERS_WEIGHT = 0.10
OTHER_COUNTRIES = 47

MIN_FILES = 4
# where a row is stored tells even copies of one event apart
PLACE = ("file_path", "row_index")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _country(event_id: Column) -> Column:
    slot = event_id % 1000
    return (
        F.when(slot < 550, "US")
        .when(slot < 800, "India")
        .when(slot < 900, "Brazil")
        .otherwise(F.concat(F.lit("C"), ((slot - 900) % 47).cast("string")))
    )


def _device(event_id: Column) -> Column:
    slot = F.call_function("div", event_id, F.lit(7)) % 20
    return pick_weighted(slot, {"mobile": 11, "desktop": 7, "tablet": 2})


def activity(spark: SparkSession, sf_dir: str, place: Sequence[str] = ()) -> DataFrame:
    """Events with country, device and a duration that clicks and errors lack;
    with ``PLACE`` also where each is stored."""
    e = table(spark, sf_dir, "events")
    if place:
        e = with_row_place(e)
    return e.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").alias("event_timestamp"),
        null_where(F.col("event_type").isin(list(EMPTY_KINDS)), F.col("value")).alias("duration_seconds"),
        _country(F.col("event_id")).alias("country"),
        _device(F.col("event_id")).alias("device_type"),
        *place,
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User profiles: the segment per user."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("user_segment")
    )


def version_frames(
    spark: SparkSession, sf_dir: str, place: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The older and newer half of the events; the newer has two more columns."""
    events = table(spark, sf_dir, "events")
    n = events.count()
    rows = activity(spark, sf_dir, place)
    number = F.col("event_id")
    old = rows.where(number * 2 < n).withColumn("app_version", pick_uniform(number, V1_APPS))
    new = (
        rows.where(number * 2 >= n)
        .withColumn("app_version", pick_uniform(number, V2_APPS))
        .withColumn("ab_test_group", pick_uniform(number, TEST_GROUPS))
        .withColumn("feature_flag", pick_uniform(number, FLAGS))
    )
    return old, new


def version_roots(spark: SparkSession, sf_dir: str) -> dict[str, tuple[str, int]]:
    """Both versions as Parquet roots in time order: name -> (path, files).

    Written once per scratch space and table folder, then shared by the queries
    that run in that space.
    """
    kept = current_space(spark).kept
    if sf_dir not in kept:
        written = {}
        order = ["event_timestamp", "event_id"]
        for name, rows in zip(("v1", "v2"), version_frames(spark, sf_dir, PLACE), strict=True):
            path = scratch_path(spark, f"events-{name}")
            files = files_for(bytes_when_written(rows.drop(*PLACE)), minimum=MIN_FILES)
            write_ordered(rows, path, files, order, place=PLACE, input_roots=[sf_dir])
            written[name] = (path, files)
        kept[sf_dir] = written
    return kept[sf_dir]


def _chunk_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int, int]:
    """The events, rows per chunk file (a quarter of them, 2,000 to a million) and chunks."""
    events = table(spark, sf_dir, "events")
    n = events.count()
    each = max(2_000, min(1_000_000, n // 4))
    return events, each, max(1, -(-n // each))


def chunk_root(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """The events in files of known rows, one file per ``chunk=N`` folder, written once per scratch space.

    ``ranged`` files hold neighbouring event ids, ``dealt`` ones every n-th, both as Parquet;
    ``lines`` are the ranged ones as text, ``id,user,type`` a line, so that their bytes are known as well.
    """
    kept = current_space(spark).kept
    if (sf_dir, layout) not in kept:
        events, each, chunks = _chunk_rows(spark, sf_dir)
        number = F.col("event_id") % chunks if layout == "dealt" else F.call_function("div", F.col("event_id"), F.lit(each))
        rows = events.withColumn("chunk", number)
        path = scratch_path(spark, f"events-{layout}")
        if layout == "lines":
            line = F.concat_ws(",", "event_id", "user_id", "event_type")
            rows.select("chunk", line.alias("value")).repartition("chunk").write.partitionBy("chunk").option("compression", "none").text(path)
        else:
            rows.repartition("chunk").write.partitionBy("chunk").parquet(path)
        kept[sf_dir, layout] = path
    return kept[sf_dir, layout]


def grown_root(spark: SparkSession, sf_dir: str) -> str:
    """One root whose files do not share a schema: the first third of the events has no ``ab_test_group``,
    the last third has ``user_id`` as text and no ``value``."""
    kept = current_space(spark).kept
    if (sf_dir, "grown") not in kept:
        events, path = table(spark, sf_dir, "events"), scratch_path(spark, "events-grown")
        n, part = events.count(), F.col("event_id") * 3
        group = pick_uniform(F.col("event_id"), TEST_GROUPS).alias("ab_test_group")
        user = F.col("user_id").cast("string").alias("user_id")
        events.where(part < n).select("event_id", "user_id", "value").write.parquet(f"{path}/a")
        events.where((part >= n) & (part < 2 * n)).select("event_id", "user_id", "value", group).write.parquet(f"{path}/b")
        events.where(part >= 2 * n).select("event_id", user, group).write.parquet(f"{path}/c")
        kept[sf_dir, "grown"] = path
    return kept[sf_dir, "grown"]


# ---- the same tables as SQL --------------------------------------------------

ACTIVITY_SQL = """activity as (
  select event_id, user_id, event_type, ts as event_timestamp,
    case when event_type in ('click','error') then null else value end as duration_seconds,
    case when event_id % 1000 < 550 then 'US' when event_id % 1000 < 800 then 'India'
         when event_id % 1000 < 900 then 'Brazil'
         else 'C' || cast((event_id % 1000 - 900) % 47 as varchar) end as country,
    case when (event_id // 7) % 20 < 11 then 'mobile' when (event_id // 7) % 20 < 18 then 'desktop'
         else 'tablet' end as device_type
  from events)"""

PROFILE_SQL = """profile as (
  select c_custkey as user_id, c_mktsegment as user_segment from customer)"""

VERSIONS_SQL = (
    ACTIVITY_SQL
    + """, v1 as (
  select *, case event_id % 6 when 0 then '3.0' when 1 then '3.1' when 2 then '3.2'
                              when 3 then '3.5' when 4 then '4.0' else '4.1' end as app_version
  from activity where event_id * 2 < (select count(*) from events)),
v2 as (
  select *, case event_id % 3 when 0 then '4.2' when 1 then '4.3' else '4.5' end as app_version,
    case event_id % 3 when 0 then 'control' when 1 then 'variant_a' else 'variant_b' end as ab_test_group,
    case event_id % 2 when 0 then 'enabled' else 'disabled' end as feature_flag
  from activity where event_id * 2 >= (select count(*) from events)),
versions as (select * from v1 union all by name select * from v2)"""
)


CHUNKS_SQL = """sized as (
  select greatest(2000, least(1000000, count(*) // 4)) as each, count(*) as n from events),
ranged as (select events.*, event_id // each as chunk from events, sized),
dealt as (select events.*, event_id % greatest(1, (n + each - 1) // each) as chunk from events, sized)"""


def mean_sql(value: str) -> str:
    """Plain mean to two decimals; the small term lets a half go up, for values >= 0."""
    return f"round(avg({value}) + 1e-9, 2)"


def minutes_sql(value: str) -> str:
    """Summed seconds in minutes to two decimals; the small term lets a half go up, for values >= 0."""
    return f"round(sum({value}) / 60 + 1e-9, 2)"
