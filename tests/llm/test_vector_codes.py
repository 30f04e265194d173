"""Vector codes and the GNAT against plain searches."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import gnat, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_nearest(entries, query):
    distances = [int(((query - e) ** 2).sum()) for e in entries]
    return distances.index(min(distances)), min(distances)


@pytest.mark.parametrize("entries,spread", [(1, 5), (8, 3), (9, 1), (64, 2), (64, 200), (256, 40)])
def test_gnat_is_exact(entries, spread):
    rng = np.random.default_rng(entries + spread)
    table = rng.integers(-spread, spread + 1, (entries, 4))  # small spreads have many ties and equal entries
    queries = rng.integers(-2 * spread, 2 * spread + 1, (700, 4))
    found, distance = gnat.nearest(gnat.build(table), table, queries)
    assert [(int(f), int(d)) for f, d in zip(found, distance)] == [plain_nearest(table, q) for q in queries]


def test_gnat_on_large_numbers():
    rng = np.random.default_rng(3)
    base = rng.integers(-vector_codes.LIMIT, vector_codes.LIMIT, (1, 4))
    table = base + rng.integers(-2, 3, (64, 4))  # differences vanish in doubles of the squares
    queries = -base + rng.integers(-2, 3, (300, 4))
    found, distance = gnat.nearest(gnat.build(table), table, queries)
    assert [(int(f), int(d)) for f, d in zip(found, distance)] == [plain_nearest(table, q) for q in queries]


def test_gnat_drops_subtrees(monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    table = np.concatenate([c + rng.integers(-20, 21, (8, 4)) for c in centres])
    queries = table[rng.integers(0, 64, 500)]
    seen, whole = [0], gnat.squared
    monkeypatch.setattr(gnat, "squared", lambda q, e: (seen.__setitem__(0, seen[0] + len(q)), whole(q, e))[1])
    tree = gnat.build(table)
    seen[0] = 0
    gnat.nearest(tree, table, queries)
    assert seen[0] < 0.5 * 500 * 64


def plain(rows):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in kept]
    width = len(whole[0]) // 16
    cut = [[w[p * width : (p + 1) * width] for p in range(16)] for w in whole]
    books = [[c[p] for c in cut[:64]] for p in range(16)]

    def assign():
        return [[plain_nearest(np.array(books[p]), np.array(c[p])) for p in range(16)] for c in cut]

    for _ in range(2):
        at = assign()
        for p in range(16):
            for e in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, at) if a[p][0] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    errors = [sum(d for _, d in a) for a in at]
    sums = {}
    for r, e in zip(kept, errors):
        sums[r[2]] = sums.get(r[2], 0) + e
    text = ",".join(str(x) for part in books for entry in part for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    codes = ["".join(f"{e:02x}" for e, _ in a) for a in at]
    return sorted((str(r[0]), c, e, sums[r[2]], digest) for r, c, e in zip(kept, codes, errors))


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, F.rand(2))
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = vector_codes.digest(df).select(*names).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(rows)


def vectors(n, d, seed, grid=None):
    rng = random.Random(seed)
    draw = (lambda: rng.randrange(-grid, grid + 1) / 256) if grid else (lambda: rng.gauss(0, 0.3))
    return [(i, [draw() for _ in range(d)], rng.choice([0, 1, 2, None])) for i in range(n)]


def test_codes_against_a_plain_version(spark):
    check(spark, vectors(300, 32, 1))


def test_ties_repeated_rows_and_one_component_per_part(spark):
    rows = vectors(150, 16, 2, grid=2)
    check(spark, rows + rows[:40] + [(3, [0.25] * 16, 1)])


def test_nulls_and_other_rows_without_part(spark):
    rows = vectors(70, 16, 3) + [(None, [0.5] * 16, 1), (-5, [-0.001] * 16, None)]
    bad = [(90, None, 1), (91, [], 1), (92, [None] + [0.0] * 15, 1), (93, [float("nan")] + [0.0] * 15, 1), (94, [float("-inf")] + [0.0] * 15, 2)]
    check(spark, rows + bad)


def test_fewer_rows_than_entries_and_none(spark):
    check(spark, vectors(5, 32, 4))
    assert vector_codes.digest(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0


def test_a_hot_label_and_clashing_columns(spark):
    rows = [(i, v, 7 if i % 3 else None) for i, v, _ in vectors(120, 16, 5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"code": F.lit("x"), "error": F.lit(1.5), "label_key": F.lit(2)})
    got = vector_codes.digest(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == plain(rows)


def test_other_lengths_and_sizes_are_refused(spark):
    for wrong in ([0.0] * 32, [1e6] * 16):
        df = spark.createDataFrame([(1, [0.0] * 16, 1), (2, wrong, 1)], SCHEMA)
        with pytest.raises(Exception, match="components|component is beyond"):
            vector_codes.digest(df).collect()
    with pytest.raises(ValueError):
        vector_codes.fitted(spark.createDataFrame([(1, [0.0] * 17, 1)], SCHEMA))


def test_decoded_vectors_are_near(spark):
    df = spark.createDataFrame(vectors(400, 32, 6), SCHEMA)
    books = vector_codes.fitted(df)
    codes = vector_codes.decoded(vector_codes.coded(df, books, keep=("embedding",)), books).collect()
    for r in codes:
        gap = sum((math.floor(256 * x) / 256 - y) ** 2 for x, y in zip(r["embedding"], r["approximate"]))
        assert abs(gap - r["error"] / 65536) < 1e-6
