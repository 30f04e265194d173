import collections
import random
import re

import pytest
from compare import duck_bag, spark_bag
from pyspark.sql import functions as F

from eventloom.llm import line_dedup as D
from eventloom.llm.queries import QUERIES, SQL


def brute(rows):
    """(doc, text) -> text without later windows, by plain loops."""
    split = {r: [(i, x) for i, x in enumerate((r[1] or "").split("\n")) if re.search(r"[^ \t\n\x0B\f\r]", x)] for r in rows}
    places = collections.defaultdict(set)
    for r, lines in split.items():
        for k in range(max(1, len(lines) - 2) if lines else 0):
            places[tuple(x for _, x in lines[k : k + 3])].add((r, k))
    gone = collections.defaultdict(set)
    for found in places.values():
        first = min(found, key=lambda f: (f[0][0] is not None, f[0][0] or 0, f[1]))
        for r, k in found - {first}:
            gone[r] |= {i for i, _ in split[r][k : k + 3]}
    return {r: r[1] if not gone[r] else "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in gone[r]) for r in split}


def check(spark, rows):
    df = spark.createDataFrame([(*r, "keep") for r in rows], "doc_id long, text string, places string")
    out = D.without_repeats(df)
    assert out.columns == df.columns
    want = brute(rows)
    assert collections.Counter((r["doc_id"], r["text"]) for r in out.collect()) == collections.Counter((r[0], want[r]) for r in rows)


def test_odd_rows(spark):
    passage = "one line\nanother line\nthe third line"
    rows = [(5, passage), (3, f"start\n{passage}\nend"), (9, f"a\n\n{passage}\n  \nz"), (1, None), (2, ""), (4, "\n \n\t"), (6, "short"), (7, "short"), (8, "short\n"),
            (10, "x\n" * 50), (10, "x\n" * 50), (None, f"none\n{passage}"), (11, "one line\nanother line"), (12, "\n".join(f"line {i}" for i in range(5000))),
            (13, "\n".join(f"line {i}" for i in range(2500, 6000)))]
    check(spark, rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    check(spark, [(i, "\n".join(rng.choice(["a", "b", "c", "", " "]) + rng.choice("xy") * rng.randint(0, 1) for _ in range(rng.randint(0, 9)))) for i in range(80)])


def test_no_rows_and_clashes(spark, no_docs):
    assert D.without_repeats(no_docs).count() == 0
    with pytest.raises(ValueError):
        D.without_repeats(no_docs.withColumn("dedup_hash", F.lit(1)))


def test_query(spark, sf_dir):
    names, rows = spark_bag(QUERIES["op7_line_dedup"](spark, sf_dir))
    want_names, want, _ = duck_bag(SQL["op7_line_dedup"], sf_dir)
    assert names == want_names and rows == want
