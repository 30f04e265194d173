"""Every registered query against its SQL."""

import pytest
from compare import duck_bag, spark_bag

from __spark_entry__ import entry, oracle_sql, queries
from eventloom.catalog import all_queries

# DuckDB type names that stand for the Spark ones
SAME = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    names, rows = spark_bag(df)
    sql = oracle_sql().get(name)
    if sql is None:
        assert sum(rows.values()) > 0
        return
    want_names, want, types = duck_bag(sql, sf_dir)
    assert names == want_names
    missing, extra = want - rows, rows - want
    assert not missing and not extra, (list(missing.items())[:5], list(extra.items())[:5])
    kinds = dict(df.dtypes)
    assert {n: SAME.get(t, t) for n, t in types.items()} == kinds


def test_entry(spark):
    assert entry(spark).count() == 15


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(all_queries()) - set(oracle_sql()) == {"q_dq_sizes"}
