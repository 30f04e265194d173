"""Declared schemas of the activity tables, so no read has to infer them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING = T.StringType()

EVENTS_V1 = T.StructType(
    [
        T.StructField("event_id", _STRING),
        T.StructField("user_id", _STRING),
        T.StructField("session_id", _STRING),
        T.StructField("event_type", _STRING),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("page_name", _STRING),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("device_type", _STRING),
        T.StructField("os", _STRING),
        T.StructField("country", _STRING),
        T.StructField("app_version", _STRING),
    ]
)

EVENTS_V2 = T.StructType(
    EVENTS_V1.fields
    + [T.StructField("ab_test_group", _STRING), T.StructField("feature_flag", _STRING)]
)

USER_PROFILE = T.StructType(
    [
        T.StructField("user_id", _STRING),
        T.StructField("user_segment", _STRING),
        T.StructField("signup_date", T.DateType()),
        T.StructField("account_type", _STRING),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a declared schema, in its column order and with its types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
