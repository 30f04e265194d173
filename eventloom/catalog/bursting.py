"""Gaps between a user's events, bursts, watch-listed users and running anchors.

The given events are far apart, so an hour stands for the two seconds, and
more than two gaps for more than ten.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.catalog.joining import watched_users
from eventloom.catalog.tables import CHUNKS_SQL, PLACE, chunk_root, profile, table
from eventloom.operators.joins import key_coverage
from eventloom.operators.quality import size_report, source_report
from eventloom.operators.windows import out_of_order, running_anchor
from eventloom.plans.bursts import burst_users, gap_report, gaps_by_file, watchlist_gaps
from eventloom.sources.footers import column_inventory
from eventloom.sources.inventory import file_profile
from eventloom.sources.readers import read_root, with_row_place

HOUR = 3600


def _events(spark, sf_dir):
    rows = with_row_place(table(spark, sf_dir, "events"))
    return rows.select("event_id", "user_id", F.col("ts").alias("event_timestamp"), *PLACE)


def gap_events(spark, sf_dir):
    return gap_report(_events(spark, sf_dir), max_gap=HOUR, spread_by=PLACE)


def burst(spark, sf_dir):
    return burst_users(_events(spark, sf_dir), more_than=2, max_gap=HOUR, spread_by=PLACE)


def burst_default(spark, sf_dir):
    """Gaps of two seconds or less, more than ten of them, on events into which every
    watched user's first one is put eleven more times, a second or two apart."""
    events = _events(spark, sf_dir).select("user_id", "event_timestamp")
    first = events.join(F.broadcast(watched_users(spark, sf_dir)), "user_id", "left_semi").groupBy("user_id").agg(F.min("event_timestamp").alias("first"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(11))).alias("k")
    seconds = F.col("k") + F.call_function("div", F.col("k"), F.lit(3))
    planted = first.select("user_id", "first", steps).select("user_id", (F.col("first") + F.make_dt_interval(secs=seconds)).alias("event_timestamp"))
    return burst_users(events.union(planted))


def watched_gaps(spark, sf_dir):
    # fewer than HOUR seconds, in whole seconds
    return watchlist_gaps(
        _events(spark, sf_dir), watched_users(spark, sf_dir), max_gap=HOUR - 1, spread_by=PLACE
    )


def watched_gaps_by_file(spark, sf_dir):
    """Per chunk file of the events, gaps of a watched user inside that file."""
    rows = with_row_place(read_root(spark, chunk_root(spark, sf_dir, "ranged")))
    found = gaps_by_file(
        rows, watched_users(spark, sf_dir), below=24 * HOUR, more_than=1, time="ts", spread_by=PLACE
    )
    chunk = F.regexp_extract("file_path", r"chunk=(\d+)", 1).cast("bigint")
    return found.select(chunk.alias("chunk"), "rows", "watched_rows", "tight_gaps", "passed")


def dq_sources(spark, sf_dir):
    """Watched gaps, stored order and profile coverage."""
    events, users = table(spark, sf_dir, "events"), profile(spark, sf_dir)
    return source_report(
        tight_gaps=watched_gaps(spark, sf_dir),
        stored_order=out_of_order(with_row_place(events), "ts"),
        coverage=key_coverage(events, users, "user_id"),
    )


def dq_sizes(spark, sf_dir):
    """The sizes that matter for a broadcast and a cache."""
    events = table(spark, sf_dir, "events")
    hit = F.col("event_type").isin("purchase", "error")
    share = events.agg(F.count_if(hit) / F.nullif(F.count(F.lit(1)), F.lit(0))).scalar()
    files = file_profile(spark, {"customer": f"{sf_dir}/customer.parquet"})
    columns = column_inventory(spark, f"{sf_dir}/events.parquet")
    return size_report(files, columns, ["user_id", "event_type", "value"], share)


def anchors(spark, sf_dir):
    steps = _events(spark, sf_dir).withColumn("step", F.lit(1) + F.col("event_id") % 2)
    steps = steps.drop(*PLACE)
    return running_anchor(steps, "user_id", "event_timestamp", "step", "event_id").drop("step")


QUERIES = {
    "q_gap_events": gap_events,
    "q_burst_users": burst,
    "q_burst_users_tight": burst_default,
    "q_watchlist_gaps": watched_gaps,
    "q_watchlist_gaps_by_file": watched_gaps_by_file,
    "q_running_anchor": anchors,
    "q_dq_sources": dq_sources,
    "q_dq_sizes": dq_sizes,
}

_GAPS = """g as (
  select user_id, event_timestamp, previous_timestamp,
    cast(floor(epoch(event_timestamp)) - floor(epoch(previous_timestamp)) as bigint) as gap_seconds
  from (select user_id, ts as event_timestamp,
          lag(ts) over (partition by user_id order by ts) as previous_timestamp from {source}))"""
_ALL = _GAPS.format(source="events")
_WATCHED = _GAPS.format(
    source="events where user_id in (select c_custkey from customer where c_acctbal < 0)"
)

SQL = {
    "q_gap_events": f"with {_ALL} select * from g where gap_seconds <= 3600",
    "q_burst_users": f"""with {_ALL} select user_id, count(gap_seconds) as total_count
        from g where gap_seconds <= 3600 group by user_id having count(gap_seconds) > 2""",
    "q_burst_users_tight": f"""with f as (
          select user_id, min(ts) as first from events
          where user_id in (select c_custkey from customer where c_acctbal < 0) group by user_id),
        e as (select user_id, ts from events union all
          select user_id, first + to_seconds(k + k // 3) from f, range(1, 12) as t(k)), {_GAPS.format(source="e")}
        select user_id, count(gap_seconds) as total_count
        from g where gap_seconds <= 2 group by user_id having count(gap_seconds) > 10""",
    "q_watchlist_gaps": f"""with {_WATCHED} select user_id, count(*) as tight_gaps
        from g where gap_seconds < 3600 group by user_id""",
    "q_watchlist_gaps_by_file": f"""with {CHUNKS_SQL},
        f as (select *, user_id in (select c_custkey from customer where c_acctbal < 0) as watched from ranged),
        g as (select *, case when watched then
            floor(epoch(ts)) - floor(epoch(lag(ts) over (partition by chunk, user_id order by ts))) end as gap from f)
        select chunk, count(*) as rows, count(*) filter (watched) as watched_rows,
          count(*) filter (gap < 86400) as tight_gaps, count(*) filter (gap < 86400) > 1 as passed
        from g group by chunk""",
    "q_dq_sources": f"""with {_WATCHED},
        t as (select count(*) as n from g where gap_seconds < 3600),
        o as (select count(*) as n from (select ts, lag(ts) over (order by event_id) as above from events)
              where ts < above),
        c as (select count(distinct c_custkey) * cast(100 as double) / count(distinct user_id) as pct
              from events left join customer on user_id = c_custkey)
        select 'watched_tight_gaps' as "check", cast(n as double) as value, cast(10 as double) as threshold,
          n > 10 as passed from t
        union all select 'out_of_order_rows', n, 0, n = 0 from o
        union all select 'join_coverage_pct', round(pct, 1), 80, pct > 80 from c""",
    "q_running_anchor": """
        select event_id, user_id, ts as event_timestamp,
          first_value(ts) over w + to_seconds(cast(
            sum(1 + event_id % 2) over w - first_value(1 + event_id % 2) over w as bigint)) as anchor
        from events
        window w as (partition by user_id order by ts, event_id
                     rows between unbounded preceding and current row)""",
}
