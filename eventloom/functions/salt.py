"""Salt columns: the same row always gets the same salt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "salt"


def row_salt(spread_by: Sequence[str], buckets: int | Column) -> Column:
    """Salt 0..buckets-1 from the hash of the given columns.

    Unlike rand(), a task run again after a lost executor draws the same salts.
    """
    count = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), count).cast("int")


def salt_label(key: Column, salt: Column, separator: str = "_") -> Column:
    """Key and salt as one text, for reports; joins keep them as two columns."""
    return F.concat(key, F.lit(separator), salt.cast("string"))


def label_part(label: Column, separator: str, place: int) -> Column:
    """One part of a delimited text, counted from 0; the separator is a regex."""
    return F.split(label, separator).getItem(place)


def pick_spread(df: DataFrame, spread_by: Sequence[str] | None) -> list[str]:
    """Columns that tell rows apart: the caller's choice, else all that hash."""
    if spread_by:
        return list(spread_by)
    return [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
