import numpy as np
import pyarrow as pa

from eventloom.llm import nearest as N
from eventloom.llm.queries import QUERIES
from eventloom.llm.rp_forest import grow, search

EVERY = dict(visited=1e9)  # walks all leaves, so the result is exact


def exact(ids, points, queries, k):
    out = []
    for q in queries:
        for i in np.flatnonzero(ids == q):
            score = (points * points[i]).sum(1)
            at = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
            out += [(int(q), n + 1, int(ids[j]), float(score[j])) for n, j in enumerate(at)]
    return sorted(out)


def test_trees_hold_every_row():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 8))
    tree = grow(points, 20, rng)
    leaf = tree.leaf_of(points)
    assert set(leaf) == set(range(tree.leaves)) and np.bincount(leaf).max() <= 60
    rows = [np.bincount(leaf, minlength=tree.leaves)]
    assert {x for _, x in search([tree], points[0], rows, 10**9)} == set(range(tree.leaves))
    assert search([tree], points[0], rows, 1)[0] == (0, leaf[0])
    same = grow(np.ones((100, 4)), 10, rng)
    assert same.leaves == 1 and same.leaf_of(np.ones((3, 4))).tolist() == [0, 0, 0]


def test_exact_when_all_leaves_are_walked(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 6)) * rng.uniform(0.2, 3, 300)[:, None]
    points[200:260] = points[200]  # a large group of equal vectors
    ids = rng.permutation(1000)[:300]
    df = spark.createDataFrame([(int(i), p.tolist(), 1) for i, p in zip(ids, points, strict=True)], "vec_id long, embedding array<double>, score int")
    rows = N.nearest(df, lambda v: v % 20 == 0, k=20, sample=100, **EVERY).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)
    want = exact(ids, points, [i for i in ids if i % 20 == 0], 20)
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]), (140, [1.0]),
            (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 1.0]), (3, [-1.0, 0.0]), (160, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.nearest(df, lambda v: v % 20 == 0, k=20, **EVERY).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (0, 4, 3, -1.0), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, 0.5), (20, 4, 3, -0.5)]
    assert N.nearest(df.limit(0), lambda v: v % 20 == 0).count() == 0


def test_an_id_repeated_more_than_k_times(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(N, "ROW_BLOCK", 64)
    ids = np.concatenate((np.arange(200), np.full(60, 201), np.full(60, 203), np.full(30, 20)))
    points = rng.normal(size=(350, 6))
    points[200:260] = 3 * points[0] + rng.normal(size=(60, 6)) * 1e-3  # near one query, and different
    points[260:320] = 3 * points[40]  # near another, and equal
    points[320:] += 2  # a query of many rows
    df = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, points, strict=True)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in N.nearest(df, lambda v: v % 20 == 0, k=20, **EVERY).collect())
    want = []
    for q in range(0, 200, 20):
        score = (points @ points[ids == q].T).max(1)
        best = sorted((-max(score[ids == i]), i) for i in set(ids.tolist()) - {q})[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12)


def test_a_flood_of_one_id_leaves_no_neighbour_out(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(2060, 6))
    points[:2000] = 4 + rng.normal(size=(2000, 6)) * 0.05  # different vectors of one id, near every query
    points[2000:] += 1
    ids = np.concatenate((np.full(2000, 7), np.arange(100, 160)))
    df = spark.createDataFrame([(int(i), p.tolist(), 1.0) for i, p in zip(ids, points, strict=True)], "vec_id long, embedding array<double>, of_id double")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in N.nearest(df, lambda v: v % 20 == 0, sample=500).collect())
    want = []
    for q in (100, 120, 140):
        score = (points @ points[ids == q].T).max(1)
        best = sorted((-max(score[ids == i]), i) for i in set(ids.tolist()) - {q})[:20]
        want += [(q, n + 1, i) for n, (_, i) in enumerate(best)]
    assert got == want


def test_rows_of_one_id_are_dealt_over_blocks():
    class Forest:
        value = type("F", (), {"leaves_of": staticmethod(lambda points: np.zeros((len(points), 1), np.int64))})

    rng = np.random.default_rng(4)
    n = 2000
    vectors = pa.array(rng.normal(size=(n, 2)).tolist(), pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.full(n, 7)), vectors, pa.array(rng.integers(-(2**63), 2**63 - 1, n))], names=["id", "vector", "spread"])
    dealt = pa.Table.from_batches(N._deal(Forest, 2, np.array([10]), np.array([1]), False)([batch]))
    assert len(dealt) == n and np.bincount(dealt.column("block").to_numpy(), minlength=10).max() < 300


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, points = table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float)
    rows = QUERIES["op10_nearest"](spark, sf).toPandas()
    want = {(q, v) for q, _, v, _ in exact(ids, points, [i for i in ids if i % 20 == 0], 20)}
    got = set(zip(rows["query_id"], rows["vec_id"], strict=True))
    assert len(got & want) / len(want) >= 0.9
    assert (rows.groupby("query_id")["rank"].max() == 20).all()
