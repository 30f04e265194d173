import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import mixing as M
from eventloom.llm.queries import QUERIES


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, domain string")


def brute_fit(tokens, p, wanted, steps=2000):
    """Projected gradient in plain numpy, with the same metric."""
    total = tokens.sum()
    inverse = np.linalg.pinv((p * tokens[:, None]).T @ p / total, rcond=1e-6, hermitian=True)
    rate = np.ones(len(p))
    for _ in range(steps):
        rate = np.maximum(0, rate - p @ (inverse @ (p.T @ (tokens * rate) / total - wanted)))
    return p.T @ (tokens * rate) / total


def test_targets_are_met(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = M.labelled_by_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    for weights in (M.WEIGHTS, {"fr/1": 1.0, "de/1": 0.2}):
        mix, table = M.fit(docs, marks, weights)
        found = table.select("tokens", "p").toPandas()
        tokens, p = found["tokens"].to_numpy(float), np.array(found["p"].tolist())
        assert np.allclose(p.sum(1), 1)
        total, wanted = tokens.sum(), np.array(mix.targets) / tokens.sum()
        rate = np.array([r["r"] for r in table.select(mix.rate(F.col("p")).alias("r")).collect()])
        assert rate.min() >= 0
        assert np.allclose(p.T @ (tokens * rate), mix.reached, rtol=1e-9)
        miss = np.abs(np.array(mix.reached) / total - wanted).max()
        assert miss <= max(0.01, np.abs(brute_fit(tokens, p, wanted) - wanted).max() + 2e-3)


def test_a_miss_is_reported(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = M.labelled_by_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    monkeypatch.setattr(M, "STEPS", 0)
    with pytest.warns(UserWarning, match="miss the target"):
        mix, _ = M.fit(docs, marks, M.WEIGHTS)
    total = docs.select(F.sum(M.token_count("text"))).first()[0]
    assert mix.miss > M.TOLERANCE and np.isclose(mix.miss, np.abs(np.array(mix.reached) - mix.targets).max() / total)


def test_good_domains_are_not_thinned(spark, sf_dir):
    rows = QUERIES["op3_mixing"](spark, sf_dir)
    assert rows.columns == ["doc_id", "n_tokens", "domain", "posterior", "rate", "copies"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows.count() == docs.count()
    assert rows.where("domain like '%/1' and posterior > 0.999 and rate < 0.98").count() == 0
    assert rows.where("copies not in (floor(rate), floor(rate) + 1)").count() == 0
    right = rows.join(docs, "doc_id").where("left(domain, 2) = lang").count()
    assert right >= 0.97 * docs.count()


def test_documents_follow_their_copies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("copies", F.lit("clash"))
    marks = M.labelled_by_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = M.mixed(docs, marks, M.WEIGHTS)
    assert out.columns == docs.columns
    want = {r["doc_id"]: r["copies"] for r in M.rates(docs, marks, M.WEIGHTS).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


def test_domains_without_a_weight_stay(spark):
    kinds = {"x": "aaaa zz", "y": "oooo qu", "z": "%%%% ||"}
    rows = [(i, x, f"{kinds[x]} " * (3 + i % 5) + str(i)) for i, x in enumerate("xyz" * 100)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    marks = labelled(spark, [(i, x) for i, x, _ in rows if i % 2])
    for weights, whole in (({"x": 0.9, "y": 0.1}, ()), ({"x": 0.9, "y": 0.1}, ("x",)), ({"x": 0.5, "y": 0.5}, ("x",))):
        mix, table = M.fit(docs, marks, weights, whole=whole)
        before = table.agg(F.sum(F.col("tokens") * F.get("p", 2)) / F.sum("tokens")).first()[0]
        assert abs(mix.targets[2] / sum(mix.targets) - before) < 1e-9 and abs(mix.reached[2] / sum(mix.reached) - before) < 1e-3
        out = {r["doc_id"] for r in M.mixed(docs, marks, weights, whole=whole).collect()}
        assert sum(i in out for i, x, _ in rows if x == "z") >= 95
        mix, _ = M.fit(docs, marks, {"x": 0.9, "y": 0.1, "z": 0.0})
        assert mix.targets[2] == 0


def test_rows_without_an_id_have_coins_of_their_own(spark):
    rows = [(None, f"oooo qu {i}") for i in range(300)] + [(i, f"aaaa zz {i}") for i in range(300)] + [(1000 + i, f"oooo qu {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = labelled(spark, [(i, "x") for i in range(300)] + [(1000 + i, "y") for i in range(20)])
    out = M.mixed(docs, marks, {"x": 0.75, "y": 0.25})
    assert 50 < out.where("doc_id is null").select("text").distinct().count() < 250
    copies = M.rates(docs, marks, {"x": 0.75, "y": 0.25}).where("doc_id is null").agg(F.sum("copies")).first()[0]
    assert copies == out.where("doc_id is null").count()


def test_classifier_is_gaussian_naive_bayes(spark):
    docs = spark.createDataFrame([(1, "aaaa zz"), (2, "aaa ooz"), (3, "oooo qu"), (4, "ooou th!"), (5, "aa oo")], "doc_id long, text string")
    marks = labelled(spark, [(1, "x"), (2, "x"), (3, "y"), (4, "y"), (9, "y"), (5, None)])
    table = docs.select("doc_id", M.features("text").alias("features"))
    model = M.classifier(table, marks, "doc_id")
    f = {r["doc_id"]: np.array(r["features"]) for r in table.collect()}
    assert model.domains == ["x", "y"] and model.prior == [0.5, 0.5]
    assert np.allclose(model.mean, [(f[1] + f[2]) / 2, (f[3] + f[4]) / 2])
    odds = [-(((f[5] - m) ** 2 / np.array(v) + np.log(v)).sum() / 2 / M.SOFTNESS) for m, v in zip(model.mean, model.variance, strict=True)]
    want = np.exp(odds - np.max(odds)) / np.exp(odds - np.max(odds)).sum()
    got = table.where("doc_id = 5").select(model.posteriors(F.col("features")).alias("p")).first()["p"]
    assert np.allclose(got, want)


def test_odd_rows(spark, odd_docs, no_docs):
    marks = labelled(spark, [(1, "x"), (5, "x"), (10, "y"), (12, "y"), (None, "y"), (2, None), (99, "z")])
    rows = M.rates(odd_docs, marks, {"x": 0.5, "y": 0.5, "nowhere": 3.0})
    assert rows.count() == odd_docs.count()
    assert rows.where("rate is null or rate < 0 or copies is null").count() == 0
    assert {r["n_tokens"] for r in rows.where("doc_id in (2, 3, 4)").collect()} == {0}
    assert M.mixed(odd_docs, marks, {"x": 1.0, "y": 1.0}).columns == odd_docs.columns
    assert M.rates(no_docs, marks, {"x": 1.0}).count() == 0 and M.mixed(no_docs, marks, {"x": 1.0}).count() == 0
    bare = M.rates(odd_docs, marks.limit(0), {"x": 1.0})
    assert {(r["rate"], r["copies"], r["domain"]) for r in bare.collect()} == {(1.0, 1, None)}
    assert M.mixed(odd_docs, marks.limit(0), {"x": 1.0}).count() == odd_docs.count()


def test_repeated_labelled_ids_count_once(spark):
    docs = spark.createDataFrame([(1, "en", "t")] * 300 + [(2, "en", "u")], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([(1, 1)] * 300 + [(2, 0)], "doc_id long, quality int")
    found = M.labelled_by_quality(docs, labels)
    assert sorted(tuple(r) for r in found.collect()) == [(1, "en/1"), (2, "en/0")]
    table = docs.select("doc_id", M.features("text").alias("features"))
    model = M.classifier(table, found.union(found), "doc_id")
    assert [round(p * 301) for p in model.prior] == [1, 300]
