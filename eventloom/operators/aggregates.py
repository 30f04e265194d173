"""Counts, salted two-phase aggregates, shares and skew figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.salt import SALT, row_salt

# how a partial result is formed, and how partial results are combined
_PARTIAL = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def count_by(df: DataFrame, *keys: str, name: str = "total_events") -> DataFrame:
    """Rows per key; null is a key like any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, tuple[str, str | Column]],
    *,
    buckets: int,
    spread_by: Sequence[str],
) -> DataFrame:
    """Aggregate by (key, salt), then combine the pieces by key.

    ``measures`` maps an output name to (kind, column), kind being count, sum,
    min, max or avg; column "*" counts rows. An average travels as a sum and a
    count. Salts are a function of ``spread_by``, so pieces are repeatable.
    """
    partials, finals = [], []
    for name, (kind, column) in measures.items():
        value = F.lit(1) if isinstance(column, str) and column == "*" else column
        if kind == "avg":
            partials += [F.sum(value).alias(f"{name}__sum"), F.count(value).alias(f"{name}__n")]
            finals.append(
                (F.sum(f"{name}__sum") / F.nullif(F.sum(f"{name}__n"), F.lit(0))).alias(name)
            )
        elif kind in _PARTIAL:
            partials.append(_PARTIAL[kind](value).alias(f"{name}__part"))
            finals.append(_COMBINE[kind](f"{name}__part").alias(name))
        else:
            raise ValueError(f"unknown measure {kind}")
    pieces = df.withColumn(SALT, row_salt(spread_by, buckets)).groupBy(*keys, SALT).agg(*partials)
    return pieces.groupBy(*keys).agg(*finals)


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: all rows, and per column the rows without a value."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in columns],
    )


def share_of_rows(condition: Column) -> Column:
    """Aggregate: percentage of rows meeting a condition; unknown counts as not."""
    met = F.coalesce(condition, F.lit(False)).cast("int")
    return F.sum(met) * F.lit(100.0) / F.nullif(F.count(F.lit(1)), F.lit(0))


def value_shares(df: DataFrame, key: str, places: int = 1) -> DataFrame:
    """Rows and percentage of all rows per key. The total is one number summed
    from the same counts, so no window pulls every key into one task."""
    counts = count_by(df, key, name="n")
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", F.round(F.col("n") * F.lit(100.0) / total, places))


def top_values(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most frequent keys, ties by key."""
    return value_shares(df, key).orderBy(F.col("n").desc(), F.col(key).asc()).limit(n)


def skew_profile(df: DataFrame, key: str) -> DataFrame:
    """One row: heaviest and lightest key, their rows, and the whole-number ratio.

    Ties go to the smaller key. Only per-key counts reach the last step, and
    those are reduced before it.
    """
    counts = count_by(df.where(F.col(key).isNotNull()), key, name="n")
    heavy = F.min(F.struct((-F.col("n")).alias("neg"), F.col(key).alias("k")))
    light = F.min(F.struct(F.col("n").alias("n"), F.col(key).alias("k")))
    return counts.agg(
        F.count(F.lit(1)).alias("keys"), heavy.alias("h"), light.alias("l")
    ).select(
        "keys",
        F.col("h.k").alias("heaviest"),
        (-F.col("h.neg")).alias("heaviest_rows"),
        F.col("l.k").alias("lightest"),
        F.col("l.n").alias("lightest_rows"),
        F.call_function("div", -F.col("h.neg"), F.col("l.n")).alias("ratio"),
    )


def scaled_counts(part: DataFrame, key: str, total_rows: Column) -> DataFrame:
    """Counts in one part of a table scaled up to ``total_rows``, rounded down.

    An estimate; ``count_by`` on the whole table is exact.
    """
    counts = count_by(part, key, name="n")
    seen = counts.agg(F.sum("n").cast("decimal(20,0)")).scalar()
    grown = F.call_function("div", F.col("n").cast("decimal(20,0)") * total_rows.cast("decimal(18,0)"), seen)
    return counts.withColumn("estimated_rows", grown.cast("bigint"))


def expected_vs_actual(df: DataFrame, key: str, weights: DataFrame) -> DataFrame:
    """Per weighted key: rows expected from its weight (rounded down) and rows found.

    ``weights`` has columns ``key`` and ``weight``; a key without rows shows 0.
    """
    counts = count_by(df, key, name="actual_rows")
    total = F.coalesce(counts.agg(F.sum("actual_rows")).scalar(), F.lit(0))
    expected = F.floor(F.col("weight").cast("decimal(10,9)") * total.cast("decimal(20,0)"))
    return (
        weights.join(counts, key, "left")
        .withColumn("expected_rows", expected.cast("bigint"))
        .select(
            key,
            "expected_rows",
            F.coalesce("actual_rows", F.lit(0)).cast("bigint").alias("actual_rows"),
        )
    )
