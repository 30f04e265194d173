"""Grow the given tables into larger ones for trial runs at scale.

    python tools/grow_tables.py SOURCE TARGET COPIES [HOT_SHARE]

Events are repeated COPIES times with new event ids, later times and other
users; HOT_SHARE of them (default 0) go to one user, and a third of that
user's go to one moment. Customers are repeated to cover all users.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from eventloom.session import build_session

USERS = 200_000
HOT_USER = 7


def main(source: str, target: str, copies: int, hot_share: float = 0.0) -> None:
    spark = build_session("eventloom-grow", master="local[8]", shuffle_partitions=8)
    events = spark.read.parquet(f"{source}/events.parquet")
    n, users = events.agg(F.count(F.lit(1)), F.max("user_id") + 1).first()
    groups = max(1, USERS // users)
    draw = F.pmod(F.xxhash64("event_id"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    hot = draw < F.lit(hot_share)
    grown = (
        events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("event_id", F.col("event_id") + F.col("copy") * F.lit(n))
        .withColumn(
            "user_id",
            F.when(hot, F.lit(HOT_USER)).otherwise(F.col("user_id") + F.col("copy") % groups * F.lit(users)),
        )
        .withColumn(
            "ts",
            F.when(hot & (draw < F.lit(hot_share / 3)), F.lit("2024-02-02 02:02:02").cast("timestamp_ntz"))
            .otherwise(F.col("ts") + F.make_dt_interval(secs=F.col("copy") * 7)),
        )
        .withColumn("user_id", F.col("user_id").cast("bigint"))
        .select(events.columns)
    )
    # one file per million rows, as a daily feed would leave them
    grown.repartition(max(1, copies * n // 1_000_000)).write.parquet(f"{target}/events.parquet")

    customers = spark.read.parquet(f"{source}/customer.parquet")
    m = customers.agg(F.max("c_custkey") + 1).first()[0]
    more = F.sequence(F.lit(0), F.lit(max(0, groups * users // m)))
    (
        customers.withColumn("copy", F.explode(more))
        .withColumn("c_custkey", F.col("c_custkey") + F.col("copy") * F.lit(m))
        .select(customers.columns)
        .write.parquet(f"{target}/customer.parquet")
    )
    for name in ("nation", "region", "supplier", "part", "documents", "labels"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{target}/{name}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]), *(float(x) for x in sys.argv[4:5]))
