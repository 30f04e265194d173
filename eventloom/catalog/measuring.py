"""Mean durations, top groups, minutes per user, and the quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.catalog.tables import (
    ACTIVITY_SQL,
    COUNTRY_WEIGHTS,
    OTHERS_WEIGHT,
    PROFILE_SQL,
    activity,
    mean_sql,
    minutes_sql,
    profile,
)
from eventloom.operators.quality import quality_report
from eventloom.plans.durations import (
    MEAN,
    duration_report,
    mean_duration,
    mean_of_means,
    minutes_per_user,
    top_groups,
    weighted_mean,
)

KEYS = ["country", "device_type", "user_segment"]


def _means(spark, sf_dir, **options):
    return mean_duration(activity(spark, sf_dir), profile(spark, sf_dir), KEYS, **options)


def avg_by_three_keys(spark, sf_dir):
    return _means(spark, sf_dir)


def avg_by_three_keys_large_profile(spark, sf_dir):
    """The plan for a profile too large to broadcast."""
    return _means(spark, sf_dir, max_bytes=0)


def topk_per_device(spark, sf_dir):
    return top_groups(_means(spark, sf_dir), "device_type")


def means_of_means(spark, sf_dir):
    return mean_of_means(_means(spark, sf_dir), "user_segment")


def row_means(spark, sf_dir):
    return weighted_mean(activity(spark, sf_dir), profile(spark, sf_dir), "user_segment")


def report(spark, sf_dir):
    return duration_report(activity(spark, sf_dir), profile(spark, sf_dir))


def minutes_by_user(spark, sf_dir):
    return minutes_per_user(activity(spark, sf_dir))


def dq_report(spark, sf_dir):
    return quality_report(
        activity(spark, sf_dir), key="country", weights={**COUNTRY_WEIGHTS, "others": OTHERS_WEIGHT}
    )


QUERIES = {
    "q_avg_by_three_keys": avg_by_three_keys,
    "q_avg_by_three_keys_large_profile": avg_by_three_keys_large_profile,
    "q_topk_per_device": topk_per_device,
    "q_mean_of_means": means_of_means,
    "q_row_mean_by_segment": row_means,
    "q_duration_report": report,
    "q_minutes_by_user": minutes_by_user,
    "q_dq_report": dq_report,
}

_MEANS = f"""{ACTIVITY_SQL}, {PROFILE_SQL}, means as (
  select country, device_type, user_segment, {mean_sql('duration_seconds')} as {MEAN}
  from activity join profile on activity.user_id = profile.user_id
  group by country, device_type, user_segment)"""
_TOP = f"""top as (
  select * from (select *, row_number() over (partition by device_type
      order by {MEAN} desc nulls last, country, user_segment) as rn from means) where rn <= 5)"""
_OVERALL = f"""overall as (
  select user_segment, {mean_sql(MEAN)} as mean_of_group_means from means group by user_segment)"""
_AVG = f"with {_MEANS} select * from means"

MINUTES_SQL = f"""with {ACTIVITY_SQL}
  select user_id, cast({minutes_sql('duration_seconds')} as varchar) as total_duration_minutes
  from activity group by user_id"""

SQL = {
    "q_avg_by_three_keys": _AVG,
    "q_avg_by_three_keys_large_profile": _AVG,
    "q_topk_per_device": f"with {_MEANS}, {_TOP} select * replace (cast(rn as integer) as rn) from top",
    "q_mean_of_means": f"with {_MEANS}, {_OVERALL} select * from overall",
    "q_row_mean_by_segment": f"""with {ACTIVITY_SQL}, {PROFILE_SQL}
        select user_segment, {mean_sql('duration_seconds')} as row_mean
        from activity join profile on activity.user_id = profile.user_id group by user_segment""",
    "q_duration_report": f"""with {_MEANS}, {_TOP}, {_OVERALL}
        select 'top' as part, country, device_type, user_segment, {MEAN} as value from top
        union all
        select 'mean', null, null, user_segment, mean_of_group_means from overall""",
    "q_minutes_by_user": MINUTES_SQL,
    "q_dq_report": f"""with {ACTIVITY_SQL},
        c as (select country, count(*) as n from activity group by country),
        f as (select
            (select sum(n) from (select n from c order by n desc, country limit 3)) * cast(100 as double)
              / (select count(*) from activity) as top_share,
            (select max(n) // min(n) from c) as ratio,
            (select count(*) filter (duration_seconds is null) * cast(100 as double) / count(*)
             from activity where event_type in ('click', 'error')) as empty_share,
            (select count(*) filter (event_type in ('purchase', 'error')) * cast(100 as double) / count(*)
             from activity) as money_share)
        select 'weights_gap' as "check", cast(round(abs(0.55 + 0.25 + 0.10 + 0.10 - 1), 6) as double) as value,
          cast(1e-9 as double) as threshold, abs(0.55 + 0.25 + 0.10 + 0.10 - 1) < 1e-9 as passed
        union all select 'top_share_pct', round(top_share, 1), 80, top_share >= 80 from f
        union all select 'skew_ratio', ratio, 150, ratio >= 150 from f
        union all select 'skew_status', ratio, 150, top_share >= 80 and ratio >= 150 from f
        union all select 'partition_ratio', ratio, 100, ratio >= 100 from f
        union all select 'null_alignment_pct', round(empty_share, 1), 95, empty_share > 95 from f
        union all select 'purchase_error_pct', round(money_share, 1), 0, money_share > 0 from f""",
}
