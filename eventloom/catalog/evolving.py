"""Two versions of the events, the newer with two more columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.catalog.tables import (
    CHUNKS_SQL,
    V1_APPS,
    VERSIONS_SQL,
    activity,
    chunk_root,
    grown_root,
    version_frames,
    version_roots,
)
from eventloom.operators.aggregates import count_by, missing_counts
from eventloom.operators.evolution import column_changes, missing_flags, only_adds, schema_drift
from eventloom.operators.sets import rows_outside, shared_values, unknown_values
from eventloom.sources.footers import column_inventory, schema_changes
from eventloom.sources.inventory import file_profile, root_totals
from eventloom.sources.readers import (
    read_merged,
    read_part,
    read_root,
    read_unmerged,
    read_versions,
    union_versions,
)

NEW_COLUMNS = ["ab_test_group", "feature_flag"]


def _paths(spark, sf_dir):
    return {name: path for name, (path, _) in version_roots(spark, sf_dir).items()}


def _merged(spark, sf_dir):
    return read_merged(spark, *_paths(spark, sf_dir).values())


def evolve_counts(spark, sf_dir):
    return missing_counts(_merged(spark, sf_dir), NEW_COLUMNS)


def evolve_by_group(spark, sf_dir):
    versions = read_versions(spark, list(_paths(spark, sf_dir).values()))
    return count_by(versions, "ab_test_group", name="total_counts")


def evolve_union(spark, sf_dir):
    """Both versions by name, without files."""
    return union_versions(version_frames(spark, sf_dir))


def evolve_merged_rows(spark, sf_dir):
    """Both versions by name, read from both roots at once."""
    return _merged(spark, sf_dir)


def evolve_first_schema(spark, sf_dir):
    """A plain read of both roots: the first file's columns, every row."""
    paths = _paths(spark, sf_dir)
    return count_by(read_unmerged(spark, paths["v1"], paths["v2"]), "app_version")


def null_flags(spark, sf_dir):
    return missing_flags(_merged(spark, sf_dir), NEW_COLUMNS, keep=["event_id"])


def drift(spark, sf_dir):
    old, new = (read_root(spark, path) for path in _paths(spark, sf_dir).values())
    return schema_drift(old, new)


def drift_status(spark, sf_dir):
    """Whether the newer version differs by the expected columns only, with its rows."""
    old, new = (read_root(spark, path) for path in _paths(spark, sf_dir).values())
    added = [name for name, what, _, _ in column_changes(old.schema, new.schema) if what == "added"]
    return new.agg(
        F.lit(",".join(added)).alias("added"),
        F.lit(only_adds(old.schema, new.schema, NEW_COLUMNS)).alias("passed"),
        F.count(F.lit(1)).alias("new_rows"),
    )


def domain_leak(spark, sf_dir):
    """App versions of either version that the older one does not allow."""
    old, new = (read_root(spark, path) for path in _paths(spark, sf_dir).values())
    leaks = rows_outside(old, "app_version", list(V1_APPS)).withColumn("root", F.lit("v1"))
    return leaks.unionByName(rows_outside(new, "app_version", list(V1_APPS)).withColumn("root", F.lit("v2")))


def domain_shared(spark, sf_dir):
    """Event types found in both versions; app versions share none."""
    old, new = (read_root(spark, path) for path in _paths(spark, sf_dir).values())
    kinds = shared_values(old, new, "event_type").select(
        F.lit("event_type").alias("column_name"), F.col("event_type").alias("value")
    )
    apps = shared_values(old, new, "app_version").select(
        F.lit("app_version").alias("column_name"), F.col("app_version").alias("value")
    )
    return kinds.unionByName(apps)


def domain_unknown(spark, sf_dir):
    """Devices that segment 'mobile' reports do not cover."""
    events = activity(spark, sf_dir)
    return unknown_values(events, events.where(F.col("device_type") == "mobile"), "device_type")


def file_totals(spark, sf_dir):
    """Files, bytes and rows of every chunk of text lines and of all, against the number of files
    that were asked for: one per chunk, but for the last chunk one more than there is."""
    path = chunk_root(spark, sf_dir, "lines")
    chunk = F.regexp_extract("file_path", r"chunk=(\d+)", 1)
    files = file_profile(spark, {"lines": path}, "text").withColumn("root", chunk)
    totals = root_totals(files)
    last = files.agg(F.max(F.col("root").cast("bigint"))).scalar()
    wrong = F.coalesce(F.try_to_number("root", F.lit("999999999999")).cast("bigint") == last, F.lit(False))
    expected = F.when(F.col("root") != "all", F.lit(1) + wrong.cast("bigint")).cast("bigint")
    return totals.withColumn("expected_files", expected).withColumn("files_ok", F.col("files") == F.col("expected_files"))


def file_rows(spark, sf_dir):
    """One part file read on its own, the last chunk's: the rows its footer states, and those found."""
    path = chunk_root(spark, sf_dir, "ranged")
    stated = file_profile(spark, {"ranged": path})
    number = F.regexp_extract("file_path", r"chunk=(\d+)", 1).cast("bigint")
    last = stated.agg(F.max_by("file_path", number).alias("p"), F.max_by("rows", number).alias("n")).first()
    return read_part(spark, path, last["p"]).agg(
        F.max("chunk").cast("bigint").alias("chunk"),
        F.lit(last["n"]).cast("bigint").alias("stated_rows"),
        F.count(F.lit(1)).alias("rows"),
        F.min("event_id").alias("first_id"),
    )


def drift_by_file(spark, sf_dir):
    """Columns that appear, vanish or change their type within one root, with the rows of their files."""
    found = schema_changes(column_inventory(spark, grown_root(spark, sf_dir)))
    return found.select("column_name", "type", "rows", "all_rows", "change")


QUERIES = {
    "q_evolve_counts": evolve_counts,
    "q_evolve_by_group": evolve_by_group,
    "q_evolve_union": evolve_union,
    "q_evolve_merged_rows": evolve_merged_rows,
    "q_evolve_first_schema": evolve_first_schema,
    "q_missing_flags": null_flags,
    "q_schema_drift": drift,
    "q_schema_drift_status": drift_status,
    "q_domain_leak": domain_leak,
    "q_domain_shared": domain_shared,
    "q_domain_unknown": domain_unknown,
    "q_schema_by_file": drift_by_file,
    "q_file_profile": file_totals,
    "q_file_part": file_rows,
}

_OLD_COLUMNS = (
    ("event_id", "bigint"),
    ("user_id", "bigint"),
    ("event_type", "string"),
    ("event_timestamp", "timestamp_ntz"),
    ("duration_seconds", "double"),
    ("country", "string"),
    ("device_type", "string"),
    ("app_version", "string"),
)
_DRIFT = [
    f"""select '{name}' as column_name, 'same' as change, '{kind}' as old_type, '{kind}' as new_type,
      (select count({name}) from v1) as old_filled, (select count({name}) from v2) as new_filled"""
    for name, kind in _OLD_COLUMNS
] + [
    f"""select '{name}', 'added', null, 'string', cast(0 as bigint), (select count({name}) from v2)"""
    for name in NEW_COLUMNS
]

SQL = {
    "q_evolve_counts": f"""with {VERSIONS_SQL} select count(*) as total_rows,
          count(*) filter (ab_test_group is null) as ab_test_group_missing,
          count(*) filter (feature_flag is null) as feature_flag_missing from versions""",
    "q_evolve_by_group": f"""with {VERSIONS_SQL} select ab_test_group, count(*) as total_counts
        from versions group by ab_test_group""",
    "q_evolve_union": f"with {VERSIONS_SQL} select * from versions",
    "q_evolve_merged_rows": f"with {VERSIONS_SQL} select * from versions",
    "q_evolve_first_schema": f"""with {VERSIONS_SQL} select app_version, count(*) as total_events
        from versions group by app_version""",
    "q_missing_flags": f"""with {VERSIONS_SQL} select event_id,
          cast(case when ab_test_group is null then 1 end as integer) as ab_test_group_null,
          cast(case when feature_flag is null then 1 end as integer) as feature_flag_null from versions""",
    "q_schema_drift": f"with {VERSIONS_SQL} " + " union all ".join(_DRIFT),
    "q_schema_drift_status": f"""with {VERSIONS_SQL}
        select 'ab_test_group,feature_flag' as added, true as passed, count(*) as new_rows from v2""",
    "q_domain_leak": f"""with {VERSIONS_SQL}
        select app_version, count(*) as rows, 'v1' as root from v1
          where app_version not in ('3.0','3.1','3.2','3.5','4.0','4.1') group by app_version
        union all
        select app_version, count(*), 'v2' from v2
          where app_version not in ('3.0','3.1','3.2','3.5','4.0','4.1') group by app_version""",
    "q_domain_shared": f"""with {VERSIONS_SQL}
        select 'event_type' as column_name, event_type as value
          from (select event_type from v1 intersect select event_type from v2)
        union all
        select 'app_version', app_version
          from (select app_version from v1 intersect select app_version from v2)""",
    "q_domain_unknown": f"""with {VERSIONS_SQL}
        select device_type from activity
        except select device_type from activity where device_type = 'mobile'""",
    "q_schema_by_file": """with p as (
          select *, event_id * 3 // (select count(*) from events) as part from events),
        c as (
          select 'event_id' as column_name, 'int64' as type, part from p
          union all select 'user_id', case when part < 2 then 'int64' else 'string' end, part from p
          union all select 'value', 'double', part from p where part < 2
          union all select 'ab_test_group', 'string', part from p where part > 0),
        k as (select column_name, count(distinct type) as types, count(distinct part) as parts from c group by column_name)
        select column_name, type, count(*) as rows, (select count(*) from events) as all_rows,
          case when any_value(parts) < 3 then 'partial' when any_value(types) > 1 then 'retyped' else 'same' end as change
        from c join k using (column_name) group by column_name, type""",
    "q_file_profile": f"""with {CHUNKS_SQL},
        l as (select cast(chunk as varchar) as root, strlen(event_id || ',' || user_id || ',' || event_type) + 1 as bytes from ranged),
        t as (select root, count(distinct root) as files, cast(sum(bytes) as bigint) as bytes, count(*) as rows,
            1 + cast(cast(root as bigint) = (select max(chunk) from ranged) as bigint) as expected_files from l group by root)
        select *, files = expected_files as files_ok from t
        union all select 'all', cast(sum(files) as bigint), cast(sum(bytes) as bigint), cast(sum(rows) as bigint), null, null from t""",
    "q_file_part": f"""with {CHUNKS_SQL}
        select chunk, count(*) as stated_rows, count(*) as rows, min(event_id) as first_id
        from ranged where chunk = (select max(chunk) from ranged) group by chunk""",
}
