"""The operators that have SQL against it, with names and types."""

import pytest
from compare import duck_bag, spark_bag

from eventloom.llm.queries import QUERIES, SQL

SAME = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_vector_codes", "op13_chat_format"])
def test_rows_of_the_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    names, rows = spark_bag(df)
    want_names, want, types = duck_bag(SQL[name], sf_dir)
    assert names == want_names and rows == want
    assert {n: SAME[t] for n, t in types.items()} == dict(df.dtypes)
