"""What a newer version of a table adds, changes and leaves empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def missing_flags(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Per row and column: 1 where the value is missing, otherwise null."""
    return df.select(*keep, *[F.when(F.col(c).isNull(), F.lit(1)).alias(f"{c}_null") for c in columns])


def column_changes(old: StructType, new: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, old type, new type) in order of the union of both schemas."""
    before = {f.name: f.dataType.simpleString() for f in old.fields}
    after = {f.name: f.dataType.simpleString() for f in new.fields}

    def change(name: str) -> str:
        if name not in before:
            return "added"
        if name not in after:
            return "removed"
        return "same" if before[name] == after[name] else "retyped"

    names = list(before) + [n for n in after if n not in before]
    return [(n, change(n), before.get(n), after.get(n)) for n in names]


def only_adds(old: StructType, new: StructType, expected: Sequence[str]) -> bool:
    """True when the newer schema differs by exactly the expected new columns."""
    changed = [(name, what) for name, what, _, _ in column_changes(old, new) if what != "same"]
    return sorted(changed) == sorted((name, "added") for name in expected)


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per column of either version: what changed, and rows with a value
    in each version. Each version is read once."""
    changes = column_changes(old.schema, new.schema)

    def filled(df: DataFrame, side: str) -> DataFrame:
        have = set(df.columns)
        counts = [
            (F.count(F.col(n)) if n in have else F.lit(0).cast("bigint")).alias(n)
            for n, _, _, _ in changes
        ]
        row = df.agg(F.count(F.lit(1)).alias("__rows"), *counts)
        cells = [
            F.struct(
                F.lit(n).alias("column_name"),
                F.lit(what).alias("change"),
                F.lit(a).cast("string").alias("old_type"),
                F.lit(b).cast("string").alias("new_type"),
                F.col(n).alias(f"{side}_filled"),
            )
            for n, what, a, b in changes
        ]
        return row.select(F.inline(F.array(*cells)))

    before = filled(old, "old")
    after = filled(new, "new").select("column_name", "new_filled")
    return before.join(after, "column_name")
