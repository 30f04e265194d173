"""Counts per key, plain and salted, shares, skew and partition balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.catalog.tables import (
    ACTIVITY_SQL,
    COUNTRY_WEIGHTS,
    OTHER_COUNTRIES,
    OTHERS_WEIGHT,
    VERSIONS_SQL,
    activity,
    table,
    version_roots,
)
from eventloom.functions.exact import hundredths
from eventloom.functions.salt import label_part, row_salt, salt_label
from eventloom.operators.aggregates import (
    count_by,
    expected_vs_actual,
    salted_aggregate,
    scaled_counts,
    share_of_rows,
    skew_profile,
    top_values,
    value_shares,
)
from eventloom.operators.layout import balance, rows_in_place
from eventloom.operators.sets import distinct_values
from eventloom.plans.bursts import events_per_user
from eventloom.sources.readers import read_root, read_versions

COUNT_SQL = f"with {ACTIVITY_SQL} select country, count(*) as total_events from activity group by country"


def count_by_country(spark, sf_dir):
    return count_by(activity(spark, sf_dir), "country")


def salted_count(spark, sf_dir):
    return salted_aggregate(
        activity(spark, sf_dir),
        ["country"],
        {"total_events": ("count", "*")},
        buckets=10,
        spread_by=["event_id"],
    )


def salted_label_count(spark, sf_dir):
    """Count by a 'country_salt' text that carries its country along, and sum.

    The country is not cut out of the text again, so it may hold the mark.
    """
    rows = activity(spark, sf_dir).select("country", "event_id")
    labelled = rows.withColumn("salted_key", salt_label(F.col("country"), row_salt(["event_id"], 10)))
    pieces = count_by(labelled, "salted_key", "country", name="n")
    return pieces.groupBy("country").agg(F.sum("n").alias("total_events"))


def salted_measures(spark, sf_dir):
    """Every measure kind through the two-phase aggregate."""
    whole = hundredths(F.col("duration_seconds"))
    return salted_aggregate(
        activity(spark, sf_dir),
        ["country"],
        {
            "n": ("count", "duration_seconds"),
            "cents": ("sum", whole),
            "least": ("min", "duration_seconds"),
            "most": ("max", "duration_seconds"),
            "mean_event_id": ("avg", "event_id"),
        },
        buckets=10,
        spread_by=["event_id"],
    )


def split_key(spark, sf_dir):
    brand = label_part(F.col("p_brand"), "#", 1)
    return table(spark, sf_dir, "part").select("p_partkey", brand.alias("brand_no"))


def user_event_count(spark, sf_dir):
    return events_per_user(table(spark, sf_dir, "events"), time="ts")


def distinct_devices(spark, sf_dir):
    return distinct_values(activity(spark, sf_dir), "device_type")


def country_share(spark, sf_dir):
    return value_shares(activity(spark, sf_dir), "country")


def top_countries(spark, sf_dir):
    return top_values(activity(spark, sf_dir), "country", 3)


def skew_ratio(spark, sf_dir):
    return skew_profile(activity(spark, sf_dir), "country")


def scaled_country_counts(spark, sf_dir):
    """Counts in the v1 root, scaled to the size of both versions."""
    roots = [path for path, _ in version_roots(spark, sf_dir).values()]
    total = read_versions(spark, roots).agg(F.count(F.lit(1))).scalar()
    return scaled_counts(read_root(spark, roots[0]), "country", total)


def expected_countries(spark, sf_dir):
    others = {f"C{i}": OTHERS_WEIGHT / OTHER_COUNTRIES for i in range(OTHER_COUNTRIES)}
    weights = spark.createDataFrame(list({**COUNTRY_WEIGHTS, **others}.items()), "country string, weight double")
    return expected_vs_actual(activity(spark, sf_dir), "country", weights)


def null_alignment(spark, sf_dir):
    rows = activity(spark, sf_dir).where(F.col("event_type").isin("click", "error"))
    return rows.agg(F.round(share_of_rows(F.col("duration_seconds").isNull()), 1).alias("null_pct"))


def category_share(spark, sf_dir):
    hit = F.col("event_type").isin("purchase", "error")
    return table(spark, sf_dir, "events").agg(
        F.count_if(hit).alias("matching_rows"), F.round(share_of_rows(hit), 1).alias("share_pct")
    )


def partition_total(spark, sf_dir):
    """Rows over all partitions of the plan as it stands; nothing may get lost."""
    parts = rows_in_place(activity(spark, sf_dir).repartition("country"))
    return balance(parts, 8).select("rows")


QUERIES = {
    "q_count_by_country": count_by_country,
    "q_salted_count": salted_count,
    "q_salted_label_count": salted_label_count,
    "q_salted_measures": salted_measures,
    "q_split_key": split_key,
    "q_user_event_count": user_event_count,
    "q_distinct_devices": distinct_devices,
    "q_country_share": country_share,
    "q_top_countries": top_countries,
    "q_skew_ratio": skew_ratio,
    "q_scaled_counts": scaled_country_counts,
    "q_expected_vs_actual": expected_countries,
    "q_null_alignment": null_alignment,
    "q_category_share": category_share,
    "q_partition_total": partition_total,
}

SQL = {
    "q_count_by_country": COUNT_SQL,
    "q_salted_count": COUNT_SQL,
    "q_salted_label_count": COUNT_SQL,
    "q_salted_measures": f"""with {ACTIVITY_SQL}
        select country, count(duration_seconds) as n,
          cast(sum(cast(round(duration_seconds * 100) as bigint)) as bigint) as cents,
          min(duration_seconds) as least, max(duration_seconds) as most,
          cast(sum(event_id) as double) / count(event_id) as mean_event_id
        from activity group by country""",
    "q_split_key": "select p_partkey, split_part(p_brand, '#', 2) as brand_no from part",
    "q_user_event_count": "select user_id, count(ts) as event_count from events group by user_id",
    "q_distinct_devices": f"with {ACTIVITY_SQL} select distinct device_type from activity",
    "q_country_share": f"""with {ACTIVITY_SQL}
        select country, count(*) as n,
          round(count(*) * cast(100 as double) / sum(count(*)) over (), 1) as share_pct
        from activity group by country""",
    "q_top_countries": f"""with {ACTIVITY_SQL}
        select country, count(*) as n,
          round(count(*) * cast(100 as double) / sum(count(*)) over (), 1) as share_pct
        from activity group by country order by n desc, country limit 3""",
    "q_skew_ratio": f"""with {ACTIVITY_SQL},
        c as (select country, count(*) as n from activity group by country)
        select count(*) as keys,
          (select country from c order by n desc, country limit 1) as heaviest,
          max(n) as heaviest_rows,
          (select country from c order by n, country limit 1) as lightest,
          min(n) as lightest_rows, max(n) // min(n) as ratio
        from c""",
    "q_scaled_counts": f"""with {VERSIONS_SQL}
        select country, count(*) as n,
          cast(count(*) * (select count(*) from versions) // (select count(*) from v1) as bigint)
            as estimated_rows
        from v1 group by country""",
    "q_expected_vs_actual": f"""with {ACTIVITY_SQL},
        w as (select * from (values ('US', cast(0.55 as decimal(10,9))), ('India', 0.25), ('Brazil', 0.10)) as v(country, weight)
          union all select 'C' || i, cast(0.10 / 47 as decimal(10,9)) from range(47) as t(i))
        select w.country, cast(floor(w.weight * (select count(*) from activity)) as bigint) as expected_rows,
          (select count(*) from activity a where a.country = w.country) as actual_rows
        from w""",
    "q_null_alignment": f"""with {ACTIVITY_SQL}
        select round(avg(case when duration_seconds is null then 1 else 0 end) * 100, 1) as null_pct
        from activity where event_type in ('click', 'error')""",
    "q_category_share": """
        select count(*) filter (event_type in ('purchase', 'error')) as matching_rows,
          round(count(*) filter (event_type in ('purchase', 'error')) * cast(100 as double) / count(*), 1)
            as share_pct
        from events""",
    "q_partition_total": "select count(*) as rows from events",
}
