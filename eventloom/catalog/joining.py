"""Pairs on skewed keys, enrichment, watch lists and key coverage.

A number of pairs grows with the square of a key's rows and soon passes a
bigint, so the registered results show it as a double: exact up to 2^53, and
never an overflow. The operators themselves return decimal(38,0).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.catalog.tables import ACTIVITY_SQL, PROFILE_SQL, activity, profile, table
from eventloom.operators.aggregates import count_by
from eventloom.operators.joins import enrich, hot_key_join, key_coverage, only_listed, salted_join
from eventloom.plans.enrichment import first_enriched
from eventloom.plans.pairs import pairs_counted, pairs_hot_salted, pairs_salted


def _shown(pairs):
    return pairs.withColumn("total", F.col("total").cast("double"))


def self_join_pairs(spark, sf_dir):
    return _shown(pairs_counted(table(spark, sf_dir, "documents"), "lang"))


def self_join_pairs_eager(spark, sf_dir):
    return _shown(pairs_counted(table(spark, sf_dir, "documents"), "lang"))


def salted_pairs(spark, sf_dir):
    return _shown(pairs_salted(table(spark, sf_dir, "documents"), "lang", ["doc_id"], buckets=10))


def hot_key_salted_pairs(spark, sf_dir):
    return _shown(pairs_hot_salted(activity(spark, sf_dir), "country", ["event_id"]))


def country_pairs(spark, sf_dir):
    return _shown(pairs_counted(activity(spark, sf_dir), "country"))


def _country_facts(spark, sf_dir):
    """One row per country: its rows and first event id."""
    return activity(spark, sf_dir).groupBy("country").agg(
        F.count(F.lit(1)).alias("country_rows"), F.min("event_id").alias("first_id")
    )


def salted_rows(spark, sf_dir):
    """Every event with its country's figures, all countries spread."""
    rows = activity(spark, sf_dir).select("event_id", "country")
    return salted_join(
        rows, _country_facts(spark, sf_dir), "country", buckets=10, spread_by=["event_id"]
    )


def hot_key_rows(spark, sf_dir):
    """Every event with its country's figures, heavy countries spread."""
    rows = activity(spark, sf_dir).select("event_id", "country")
    return hot_key_join(rows, _country_facts(spark, sf_dir), "country", spread_by=["event_id"])


def _events_and_profile(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return events, profile(spark, sf_dir)


def enrich_shuffle(spark, sf_dir):
    events, users = _events_and_profile(spark, sf_dir)
    return first_enriched(events, users, 5, ["user_id", "event_id"], strategy="shuffle")


def enrich_broadcast(spark, sf_dir):
    events, users = _events_and_profile(spark, sf_dir)
    return first_enriched(events, users, 5, ["user_id", "event_id"], strategy="broadcast")


def enrich_rows(spark, sf_dir):
    events, users = _events_and_profile(spark, sf_dir)
    return enrich(events, users, "user_id", strategy="broadcast")


def enrich_rows_shuffle(spark, sf_dir):
    events, users = _events_and_profile(spark, sf_dir)
    return enrich(events, users, "user_id", strategy="shuffle")


def watched_users(spark, sf_dir):
    """The watch list: users whose account is overdrawn."""
    return (
        table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("user_id"))
    )


def watchlist_semi(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return only_listed(events, watched_users(spark, sf_dir), "user_id")


def segment_events(spark, sf_dir):
    events, users = _events_and_profile(spark, sf_dir)
    return count_by(enrich(events, users, "user_id", strategy="broadcast"), "user_segment")


def join_coverage(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = key_coverage(documents, labels, "doc_id")
    return found.withColumn("coverage_pct", F.round("coverage_pct", 1))


QUERIES = {
    "q_self_join_pairs": self_join_pairs,
    "q_self_join_pairs_eager": self_join_pairs_eager,
    "q_salted_join": salted_pairs,
    "q_hot_key_salted_join": hot_key_salted_pairs,
    "q_country_pairs": country_pairs,
    "q_salted_join_rows": salted_rows,
    "q_hot_key_join_rows": hot_key_rows,
    "q_enrich_shuffle": enrich_shuffle,
    "q_enrich_broadcast": enrich_broadcast,
    "q_enrich_rows": enrich_rows,
    "q_enrich_rows_shuffle": enrich_rows_shuffle,
    "q_segment_events": segment_events,
    "q_watchlist_semi": watchlist_semi,
    "q_join_coverage": join_coverage,
}

_LANG_PAIRS = """select a.lang, cast(count(*) as double) as total
    from documents a join documents b on a.lang = b.lang group by a.lang"""
_COUNTRY_PAIRS = f"""with {ACTIVITY_SQL} select a.country, cast(count(*) as double) as total
    from activity a join activity b on a.country = b.country group by a.country"""
_COUNTRY_ROWS = f"""with {ACTIVITY_SQL}, facts as (
      select country, count(*) as country_rows, min(event_id) as first_id from activity group by country)
    select a.event_id, a.country, f.country_rows, f.first_id
    from activity a join facts f on a.country = f.country"""
_ENRICHED = f"""with {PROFILE_SQL} select e.event_id, e.user_id, e.event_type, p.user_segment
    from events e join profile p on e.user_id = p.user_id"""
_FIRST = _ENRICHED + " order by e.user_id, e.event_id limit 5"

SQL = {
    "q_self_join_pairs": _LANG_PAIRS,
    "q_self_join_pairs_eager": _LANG_PAIRS,
    "q_salted_join": _LANG_PAIRS,
    "q_hot_key_salted_join": _COUNTRY_PAIRS,
    "q_country_pairs": _COUNTRY_PAIRS,
    "q_salted_join_rows": _COUNTRY_ROWS,
    "q_hot_key_join_rows": _COUNTRY_ROWS,
    "q_enrich_shuffle": _FIRST,
    "q_enrich_broadcast": _FIRST,
    "q_enrich_rows": _ENRICHED,
    "q_enrich_rows_shuffle": _ENRICHED,
    "q_segment_events": f"""with {PROFILE_SQL} select p.user_segment, count(*) as total_events
        from events e join profile p on e.user_id = p.user_id group by p.user_segment""",
    "q_watchlist_semi": """select event_id, user_id, event_type, ts from events
        where user_id in (select c_custkey from customer where c_acctbal < 0)""",
    "q_join_coverage": """select count(distinct d.doc_id) as keys,
          count(distinct l.doc_id) as covered,
          round(count(distinct l.doc_id) * cast(100 as double) / count(distinct d.doc_id), 1) as coverage_pct
        from documents d left join labels l on d.doc_id = l.doc_id""",
}
