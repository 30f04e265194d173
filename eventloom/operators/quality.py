"""Data checks as whole-table jobs: one row per check with value and verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# fixed values: thresholds of the checks
MIN_TOP_SHARE_PCT = 80.0
MIN_SKEW = 150
MIN_PARTITION_RATIO = 100
MIN_EMPTY_PCT = 95.0
WEIGHT_TOLERANCE = 1e-9
MORE_THAN_GAPS = 10
MIN_COVERAGE_PCT = 80.0
MAX_DIMENSION_BYTES = 10 * 1024 * 1024


def check_row(check: str, value: Column, threshold: float, passed: Column) -> Column:
    """One result row as a struct."""
    return F.struct(
        F.lit(check).alias("check"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def quality_report(
    events: DataFrame,
    *,
    key: str,
    weights: Mapping[str, float],
    kind: str = "event_type",
    duration: str = "duration_seconds",
    empty_kinds: Sequence[str] = ("click", "error"),
    money_kinds: Sequence[str] = ("purchase", "error"),
    top: int = 3,
    min_top_share: float = MIN_TOP_SHARE_PCT,
    min_skew: int = MIN_SKEW,
    min_ratio: int = MIN_PARTITION_RATIO,
    min_empty_share: float = MIN_EMPTY_PCT,
    weight_tolerance: float = WEIGHT_TOLERANCE,
) -> DataFrame:
    """Weights, skew and null-alignment checks from one count per key.

    The table is scanned once for counts per key; everything else is computed
    from those. The top share takes the ``top`` largest counts, cut in each
    partition before they meet.
    """
    empties = F.col(kind).isin(list(empty_kinds))
    per_key = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(empties).alias("n_empty_kind"),
        F.count_if(empties & F.col(duration).isNull()).alias("n_empty"),
        F.count_if(F.col(kind).isin(list(money_kinds))).alias("n_money"),
    )
    # a missing key is no key: its rows count among all, never as most, least or leader
    per_key = per_key.withColumn("known", F.when(F.col(key).isNotNull(), F.col("n")))
    # asks for every count, so that both uses of the per-key table share one exchange
    counts = ("n", "n_empty_kind", "n_empty", "n_money", "known")
    leaders = (
        per_key.orderBy(F.col("known").desc_nulls_last(), F.col(key))
        .limit(top)
        .agg(F.struct(*[F.sum(c).alias(c) for c in counts]))
        .scalar()
    )
    totals = per_key.agg(
        F.sum("n").alias("rows"),
        F.max("known").alias("most"),
        F.min("known").alias("least"),
        F.sum("n_empty_kind").alias("empty_kind"),
        F.sum("n_empty").alias("empty"),
        F.sum("n_money").alias("money"),
    ).withColumn("leaders", leaders["known"])

    share = lambda part, whole: F.col(part) * F.lit(100.0) / F.nullif(F.col(whole), F.lit(0))
    top_share = share("leaders", "rows")
    ratio = F.call_function("div", F.col("most"), F.col("least"))
    empty_share = share("empty", "empty_kind")
    money_share = share("money", "rows")
    weight_gap = F.abs(sum((F.lit(float(w)) for w in weights.values()), F.lit(0.0)) - F.lit(1.0))
    rows = [
        check_row("weights_gap", F.round(weight_gap, 6), weight_tolerance, weight_gap < weight_tolerance),
        check_row("top_share_pct", F.round(top_share, 1), min_top_share, top_share >= min_top_share),
        check_row("skew_ratio", ratio, min_skew, ratio >= min_skew),
        check_row(
            "skew_status", ratio, min_skew, (top_share >= min_top_share) & (ratio >= min_skew)
        ),
        check_row("partition_ratio", ratio, min_ratio, ratio >= min_ratio),
        check_row("null_alignment_pct", F.round(empty_share, 1), min_empty_share, empty_share > min_empty_share),
        check_row("purchase_error_pct", F.round(money_share, 1), 0.0, money_share > 0.0),
    ]
    return totals.select(F.inline(F.array(*rows)))


def one_check(df: DataFrame, check: str, value: Column, threshold: float, passed: Column) -> DataFrame:
    """A check over a one-row table, as a one-row table."""
    return df.select(F.inline(F.array(check_row(check, value, threshold, passed))))


def source_report(
    *,
    tight_gaps: DataFrame,
    stored_order: DataFrame,
    coverage: DataFrame,
    more_than_gaps: int = MORE_THAN_GAPS,
    min_coverage: float = MIN_COVERAGE_PCT,
) -> DataFrame:
    """Checks on a fact table and its dimension, one row each.

    ``tight_gaps`` counts short gaps per watched user, ``stored_order`` the
    out-of-order rows per file, ``coverage`` is one row from ``key_coverage``.
    """
    gaps = tight_gaps.agg(F.coalesce(F.sum("tight_gaps"), F.lit(0)).alias("v"))
    order = stored_order.agg(F.coalesce(F.sum("out_of_order"), F.lit(0)).alias("v"))
    known = coverage.select(F.round("coverage_pct", 1).alias("v"), "coverage_pct")
    v = F.col("v")
    rows = [
        one_check(gaps, "watched_tight_gaps", v, more_than_gaps, v > more_than_gaps),
        one_check(order, "out_of_order_rows", v, 0, v == 0),
        one_check(known, "join_coverage_pct", v, min_coverage, F.col("coverage_pct") > min_coverage),
    ]
    return reduce(DataFrame.unionByName, rows)


def size_report(
    dimension_files: DataFrame,
    columns: DataFrame,
    narrow: Sequence[str],
    kept_share: Column | float = 1.0,
    *,
    max_dimension_bytes: int = MAX_DIMENSION_BYTES,
) -> DataFrame:
    """Does the dimension stay small, and is the narrow table smaller than the wide one?

    ``dimension_files`` has a row per file (``file_profile``); its value is their
    bytes. ``columns`` has a row per file and column (``footers.column_inventory``): the wide
    table's bytes are those of all columns before compression, the narrow one's those of the
    named columns times the share of the rows it keeps. An empty table fails its check.
    """
    share = kept_share if isinstance(kept_share, Column) else F.lit(float(kept_share))
    stored, held = F.sum("file_bytes"), F.sum("rows")
    wide = F.sum("plain_bytes")
    slim = F.sum(F.when(F.col("column_name").isin(list(narrow)), F.col("plain_bytes")).otherwise(F.lit(0)))
    sizes = columns.agg(wide.alias("wide"), F.round(slim * share, 0).alias("slim"))
    rows = [
        dimension_files.agg(check_row("dimension_bytes", stored, max_dimension_bytes, (stored < max_dimension_bytes) & (held > 0)).alias("c")),
        sizes.select(
            F.struct(
                F.lit("narrow_bytes").alias("check"),
                F.col("slim").cast("double").alias("value"),
                F.col("wide").cast("double").alias("threshold"),
                F.coalesce((F.col("slim") < F.col("wide")) & (F.col("wide") > 0), F.lit(False)).alias("passed"),
            ).alias("c")
        ),
    ]
    return reduce(DataFrame.unionByName, rows).select("c.*")
