import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventloom.llm import language_id as L
from eventloom.llm import toxicity as T
from eventloom.llm.queries import QUERIES
from eventloom.llm.words import buffer_of

SF = "/root/testdata/sf0.1"


def crc(x, n):
    return zlib.crc32(str(x).encode()) % n


def test_subwords_share_n_grams():
    data, _ = buffer_of(pa.array(["worthless worthles W0rthless élan"]))
    text = data.tobytes()
    cut = lambda w: (text.index(w.encode()), text.index(w.encode()) + len(w.encode()))
    spans = [cut("worthless"), cut("worthles "), cut("W0rthless"), cut("élan")]
    spans[1] = (spans[1][0], spans[1][1] - 1)
    ids, splits = T.subwords(data, *map(np.array, zip(*spans, strict=True)))
    own = [set(ids[a:b].tolist()) for a, b in zip(splits[:-1], splits[1:], strict=True)]
    # <worthless>: nine 3-grams, eight 4-grams, seven 5-grams
    assert len(ids[splits[0] : splits[1]]) == 9 + 8 + 7
    assert splits[4] - splits[3] == 4 + 3 + 2  # characters, not bytes
    assert len(own[0] & own[1]) > 15 and len(own[0] & own[2]) > 10 and len(own[0] & own[3]) < 2


def test_toxicity_held_out(spark):
    rows = QUERIES["op5_toxicity"](spark, SF)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    found = rows.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert (found["held_out"] == [crc(i, 3) == 1 for i in found["doc_id"]]).all()
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= 0.7)).all()
    held = found[found["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.95
    clean = held[held["toxic"] == 0]
    assert (clean["predicted"] == 1).mean() < 0.02


def test_misspellings_are_scored_like_the_word():
    rng = np.random.default_rng(1)
    known = ["".join(rng.choice([*"aeionrst"], 6)) for _ in range(400)]
    word = lambda: known[int(rng.integers(400))]
    texts, marks = [], []
    for k in range(600):
        words = [word() for _ in range(40)]
        if k % 3 == 0:
            words[int(rng.integers(40))] = ["horrible", "horribly", "disgusting", "disgusts"][k // 3 % 4]
        texts.append(" ".join(words))
        marks.append(int(k % 3 == 0))
    model = T.fit(texts, marks)
    score = lambda t: T._row_scores(*buffer_of(pa.array([t])), model.subword)[0] * model.slope + model.intercept
    plain = " ".join(word() for _ in range(30))
    assert score(plain) < 0 < score(plain + " horriible") and score(plain + " Disgustin") > 0


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, k, 0) for i, k in ((1, 0), (5, 0), (10, 1), (8, 1), (3, 1), (2, 0), (6, None), (9, 7))], "doc_id long, toxic int, extra int")
    model = T.learn(odd_docs, labels)
    assert T.scored(odd_docs, model, score="s").count() == odd_docs.count()
    assert T.scored(odd_docs, model, score="s").where("s is null or s < 0 or s > 1").count() == 0
    assert T.scored(odd_docs, model, score="s").columns == [*odd_docs.columns, "s"]
    assert T.scored(no_docs, model, score="s").count() == 0
    for few, share in ((labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1 and doc_id <> 3"), 1.0), (labels.limit(0), 0.0)):
        scores = {round(r["s"], 6) for r in T.scored(odd_docs, T.learn(odd_docs, few), score="s").collect()}
        assert scores == {share}


def test_only_the_learning_rows_are_learned(spark, odd_docs):
    labels = spark.createDataFrame([(i, 1) for i in range(1, 13)], "doc_id long, toxic int")
    kept = labels.where(~T.held_out("doc_id")).toPandas()["doc_id"]
    assert sorted(kept) == [i for i in range(1, 13) if crc(i, 3) != 1]


def test_language_held_out(spark):
    rows = QUERIES["op6_language_id"](spark, SF)
    assert rows.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = rows.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (found["held_out"] == [crc(i, 5) == 0 for i in found["doc_id"]]).all()
    held = found[found["held_out"] & (found["lang_pred"] != "und")]
    right = held["lang_pred"] == held["lang"]
    assert right.mean() > 0.98
    assert abs(held["score"].mean() - right.mean()) < 0.02  # honest probabilities


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = L.learn(odd_docs)
    found = {(r["doc_id"], r["lang_pred"], r["s"] == 0) for r in L.predicted(odd_docs, model, score="s").collect()}
    assert {(2, "und", True), (3, "und", True), (4, "und", True), (6, "und", True)} <= found
    assert not {x for x in found if x[0] in (1, 5, 12) and x[1] == "und"}
    assert L.predicted(no_docs, model, score="s").count() == 0
    none = L.learn(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in L.predicted(odd_docs, none, score="s").collect()} == {"und"}
    assert L.learn(no_docs).languages == []


def test_l1_keeps_most_weights_at_zero(spark):
    model = L.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert 0 < (model.weights != 0).mean() < 0.5
    assert 0.04 < model.temperature < 5.1


def test_clashing_columns_are_refused(spark, odd_docs):
    model = T.learn(odd_docs, spark.createDataFrame([(1, 0), (10, 1)], "doc_id long, toxic int"))
    with pytest.raises(ValueError, match="score"):
        T.scored(odd_docs, model)
    with pytest.raises(ValueError, match="score"):
        L.predicted(odd_docs, L.learn(odd_docs))


def test_long_texts_are_learned_from(spark):
    filler = "plain words about nothing in particular " * 400
    rows = [(i, filler + (f"horrible disgusting {i}" if i % 2 else f"pleasant {i}")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen = []
    fit = T.fit
    try:
        T.fit = lambda texts, marks: (seen.append((texts, marks)), fit(texts[:4], marks[:4]))[1]
        T.learn(docs, labels, text_chars=2000)
    finally:
        T.fit = fit
    texts, marks = seen[0]
    assert 150 < len(texts) < 250 and {(m, len(t)) for t, m in zip(texts, marks)} == {(0, 2000), (1, 8000)}
    # excerpts come from anywhere in the texts
    assert len({filler.find(t[:200]) % 1000 for t in texts}) > 20


def test_a_hot_id_does_not_fill_the_driver(spark):
    rows = [(4, f"text number {i} of one id", "en" if i % 2 else "de") for i in range(900)] + [(i, f"other text {i}", "en") for i in range(10, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    fit = L.fit
    try:
        L.fit = lambda texts, names, idf: (seen.append(texts), fit(texts, names, idf))[1]
        L.learn(docs, sample=100)
        L.learn(docs.unionByName(docs).unionByName(docs), sample=100)
    finally:
        L.fit = fit
    assert [len(x) for x in seen] == [100, 100]


def test_one_step_against_plain_loops():
    # one text, one pass: FTRL by hand
    idf = np.ones(L.BUCKETS)
    at, value = L.features("ab", idf)
    model = L.fit(["ab", "zz"], ["x", "y"], idf)
    z = {i: [0.0, 0.0] for i in [*at.tolist(), *L.features("zz", idf)[0].tolist(), L.BUCKETS]}
    n = {i: [0.0, 0.0] for i in z}
    made = [L.features(t, idf) for t in ("ab", "zz")]

    def weight(i, c):
        return 0.0 if abs(z[i][c]) <= L.L1 else (np.sign(z[i][c]) * L.L1 - z[i][c]) / ((L.BETA + n[i][c] ** 0.5) / L.ALPHA + L.L2)

    order = np.random.default_rng(5).permutation(np.arange(2))
    for _ in range(L.PASSES):
        for t in order:
            pairs = [*zip(made[t][0].tolist(), made[t][1].tolist()), (L.BUCKETS, 1.0)]
            w = {i: [weight(i, c) for c in (0, 1)] for i, _ in pairs}
            odds = [sum(v * w[i][c] for i, v in pairs) for c in (0, 1)]
            top = max(odds)
            e = [np.exp(o - top) for o in odds]
            p = [x / sum(e) for x in e]
            p[t] -= 1
            for i, v in pairs:
                for c in (0, 1):
                    g = v * p[c]
                    step = ((n[i][c] + g * g) ** 0.5 - n[i][c] ** 0.5) / L.ALPHA
                    z[i][c] += g - step * w[i][c]
                    n[i][c] += g * g
    for i in z:
        for c in (0, 1):
            got = model.bias[c] if i == L.BUCKETS else model.weights[i, c]
            assert abs(got - weight(i, c)) < 1e-9
