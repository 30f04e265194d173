"""Ids, time buckets, tiers and category choices on the events' own columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.catalog.tables import (
    ACTIVITY_SQL,
    EMPTY_KINDS,
    FLAGS,
    TEST_GROUPS,
    V2_APPS,
    activity,
    table,
)
from eventloom.functions.assign import (
    null_where,
    padded_id,
    pick_uniform,
    pick_weighted,
    sample_keys,
    two_tier,
)
from eventloom.functions.moments import from_epoch, plus_days, time_bucket
from eventloom.sources.schemas import EVENTS_V2, USER_PROFILE, conform

# fixed values: start of the event and sign-up calendars, 365 days in 50 buckets
EVENTS_START = "2024-01-01 00:00:00"
SIGNUP_START = "2020-01-01"
BUCKET_SECONDS = 630_720
SIGNUP_DAYS = 1460
# fixed values: category weights per 10,000
DEVICES = {"mobile": 5500, "desktop": 3500, "tablet": 1000}
SYSTEMS = {"iOS": 3000, "Android": 3000, "Windows": 2200, "Mac": 1300, "Linux": 500}
SEGMENTS = {"Premium": 2000, "Standard": 5500, "Trial": 2500}
ACCOUNTS = {"Individual": 7000, "Business": 2200, "Enterprise": 800}
PAGES = (
    "home", "product_listing", "product_detail", "cart", "checkout", "order_confirmation", "profile",
    "settings", "search_results", "category_page", "help", "login", "signup",
)


def _draw(number, factor=7919):
    """A spread-out number 0..9999 that any SQL engine can compute."""
    return number * factor % 10000


def format_ids(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        padded_id("E", F.col("event_id"), 10).alias("event_id"),
        padded_id("U", F.col("user_id"), 7).alias("user_id"),
    )


def power_tier(spark, sf_dir):
    """The first tenth of the user numbers are the power users."""
    events = table(spark, sf_dir, "events")
    edge = events.agg(F.call_function("div", F.max("user_id") + 1, F.lit(10))).scalar()
    return events.select("event_id", "user_id", two_tier(F.col("user_id") < edge, "power", "normal").alias("tier"))


def null_rule(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id", null_where(kind.isin(list(EMPTY_KINDS)), F.col("value")).alias("duration_seconds")
    )


def time_buckets(spark, sf_dir):
    bucket = time_bucket(F.col("ts"), EVENTS_START, BUCKET_SECONDS)
    return table(spark, sf_dir, "events").select("event_id", bucket.alias("bucket"))


def epoch_to_ts(spark, sf_dir):
    moment = from_epoch(F.col("event_id") * 37, EVENTS_START)
    return table(spark, sf_dir, "events").select("event_id", moment.alias("moment"))


def signup_date(spark, sf_dir):
    day = plus_days(SIGNUP_START, F.col("c_custkey") * 31 % SIGNUP_DAYS)
    return table(spark, sf_dir, "customer").select("c_custkey", day.alias("signup_date"))


def weighted_assign(spark, sf_dir):
    device = pick_weighted(_draw(F.col("event_id")), DEVICES)
    return table(spark, sf_dir, "events").select("event_id", device.alias("device_type"))


def uniform_assign(spark, sf_dir):
    number = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        pick_uniform(number, TEST_GROUPS).alias("ab_test_group"),
        pick_uniform(number, FLAGS).alias("feature_flag"),
    )


def key_sample(spark, sf_dir):
    """Twenty users drawn in a repeatable order."""
    user = F.col("user_id")
    return sample_keys(table(spark, sf_dir, "events"), "user_id", 20, user * 7919 % 10007)


def build_profile(spark, sf_dir):
    """A user profile in the declared schema from the customers."""
    number = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        padded_id("U", number, 7).alias("user_id"),
        pick_weighted(_draw(number), SEGMENTS).alias("user_segment"),
        plus_days(SIGNUP_START, number * 31 % SIGNUP_DAYS).alias("signup_date"),
        pick_weighted(_draw(number, 6101), ACCOUNTS).alias("account_type"),
    )
    return conform(rows, USER_PROFILE)


def build_events(spark, sf_dir):
    """Events in the declared schema of the newer version, column by column."""
    number = F.col("event_id")
    rows = activity(spark, sf_dir).select(
        padded_id("E", number, 10).alias("event_id"),
        padded_id("U", F.col("user_id"), 7).alias("user_id"),
        padded_id("S", number * 13 % 500_000, 8).alias("session_id"),
        "event_type",
        "event_timestamp",
        pick_uniform(number, PAGES).alias("page_name"),
        "duration_seconds",
        "device_type",
        pick_weighted(_draw(number), SYSTEMS).alias("os"),
        "country",
        pick_uniform(number, V2_APPS).alias("app_version"),
        pick_uniform(number, TEST_GROUPS).alias("ab_test_group"),
        pick_uniform(number, FLAGS).alias("feature_flag"),
    )
    return conform(rows, EVENTS_V2)


QUERIES = {
    "q_format_ids": format_ids,
    "q_power_tier": power_tier,
    "q_null_rule": null_rule,
    "q_time_bucket": time_buckets,
    "q_epoch_to_ts": epoch_to_ts,
    "q_signup_date": signup_date,
    "q_weighted_assign": weighted_assign,
    "q_uniform_assign": uniform_assign,
    "q_key_sample": key_sample,
    "q_build_profile": build_profile,
    "q_build_events": build_events,
}


def _weighted_sql(draw: str, weights: dict[str, int]) -> str:
    reached, parts = 0, []
    for name, weight in weights.items():
        reached += weight
        parts.append(f"when {draw} < {reached} then '{name}'")
    return "case " + " ".join(parts) + " end"


def _uniform_sql(number: str, names: tuple[str, ...]) -> str:
    parts = [f"when {i} then '{name}'" for i, name in enumerate(names)]
    return f"case {number} % {len(names)} " + " ".join(parts) + " end"


_EVENT_DRAW = "event_id * 7919 % 10000"
SQL = {
    "q_format_ids": """select 'E' || lpad(cast(event_id as varchar), 10, '0') as event_id,
          'U' || lpad(cast(user_id as varchar), 7, '0') as user_id from events""",
    "q_power_tier": """select event_id, user_id,
          case when user_id < (select (max(user_id) + 1) // 10 from events) then 'power' else 'normal' end as tier
        from events""",
    "q_null_rule": """select event_id,
          case when event_type in ('click', 'error') then null else value end as duration_seconds from events""",
    "q_time_bucket": """select event_id,
          cast(floor((floor(epoch(ts)) - epoch(timestamp '2024-01-01 00:00:00')) / 630720) as bigint) as bucket
        from events""",
    "q_epoch_to_ts": """select event_id,
          timestamp '2024-01-01 00:00:00' + to_seconds(event_id * 37) as moment from events""",
    "q_signup_date": """select c_custkey,
          cast(date '2020-01-01' + cast(c_custkey * 31 % 1460 as integer) as date) as signup_date from customer""",
    "q_weighted_assign": f"select event_id, {_weighted_sql(_EVENT_DRAW, DEVICES)} as device_type from events",
    "q_uniform_assign": f"""select event_id, {_uniform_sql('event_id', TEST_GROUPS)} as ab_test_group,
          {_uniform_sql('event_id', FLAGS)} as feature_flag from events""",
    "q_key_sample": """select user_id from (select distinct user_id from events)
        order by user_id * 7919 % 10007, user_id limit 20""",
    "q_build_profile": f"""select 'U' || lpad(cast(c_custkey as varchar), 7, '0') as user_id,
          {_weighted_sql('c_custkey * 7919 % 10000', SEGMENTS)} as user_segment,
          cast(date '2020-01-01' + cast(c_custkey * 31 % 1460 as integer) as date) as signup_date,
          {_weighted_sql('c_custkey * 6101 % 10000', ACCOUNTS)} as account_type from customer""",
    "q_build_events": f"""with {ACTIVITY_SQL}
        select 'E' || lpad(cast(event_id as varchar), 10, '0') as event_id,
          'U' || lpad(cast(user_id as varchar), 7, '0') as user_id,
          'S' || lpad(cast(event_id * 13 % 500000 as varchar), 8, '0') as session_id,
          event_type, event_timestamp, {_uniform_sql('event_id', PAGES)} as page_name,
          duration_seconds, device_type, {_weighted_sql(_EVENT_DRAW, SYSTEMS)} as os, country,
          {_uniform_sql('event_id', V2_APPS)} as app_version,
          {_uniform_sql('event_id', TEST_GROUPS)} as ab_test_group,
          {_uniform_sql('event_id', FLAGS)} as feature_flag
        from activity""",
}
