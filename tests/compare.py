"""Compare a Spark result with DuckDB's on the same files, as multisets of rows."""

import datetime
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return sorted(df.columns), _bag(df.columns, df.collect())


def duck_bag(sql, sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            files = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"create view {t} as select * from read_parquet('{files}')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    types = {d[0]: str(d[1]) for d in got.description}
    return sorted(names), _bag(names, got.fetchall()), types
