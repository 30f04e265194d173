import random

import numpy as np
import pytest
from compare import duck_bag, spark_bag
from pyspark.sql import functions as F

from eventloom.llm import decontaminate as D
from eventloom.llm.fm_index import FMIndex, WaveletMatrix, suffix_order
from eventloom.llm.queries import QUERIES, SQL

ITEMS = [
    (1, "zeta eta theta iota kappa lambda mu nu xi omicron pi rho"),
    (2, "two words"),
    (3, None),
    (4, ""),
    (None, "lazy dog"),
    (20, "Zeta, eta; THETA iota kappa lambda mu nu xi omicron!"),
    (20, "Zeta, eta; THETA iota kappa lambda mu nu xi omicron!"),
]


def test_ranks_and_symbols():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 11, 300)
    waves = WaveletMatrix(symbols, 4)
    for at in (0, 1, 150, 300):
        for c in range(12):
            assert waves.rank(np.array([c]), np.array([at]))[0] == (symbols[:at] == c).sum()
    assert (waves.symbol(np.arange(300)) == symbols).all()


def test_suffix_order():
    rng = np.random.default_rng(2)
    for _ in range(50):
        symbols = np.append(rng.integers(0, 4, rng.integers(0, 40)), 0)
        breaks = np.flatnonzero(symbols == 0)
        own = [int(np.searchsorted(breaks, i)) - len(breaks) if s == 0 else int(s) for i, s in enumerate(symbols)]
        assert suffix_order(symbols).tolist() == sorted(range(len(own)), key=lambda i: own[i:])


def test_index_finds_all_places():
    rng = np.random.default_rng(3)
    for _ in range(30):
        symbols = rng.integers(0, 4, 200)
        index = FMIndex(symbols, 3)
        phrases = rng.integers(1, 4, (20, 3))
        lengths = rng.integers(1, 4, 20)
        low, high = index.search(phrases, lengths)
        for p, n, a, b in zip(phrases, lengths, low, high, strict=True):
            want = [i for i in range(200 - n + 1) if (symbols[i : i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def found(spark, docs, items, **how):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.digest(D.contamination(docs, bench, **how)).collect()
    return [(r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in rows]


def brute(docs, items):
    named = [(i, t) for i, t in items if i is not None]
    both = D.brute([r["text"] for r in docs.collect()], named)
    hits = D.brute([r["text"] for r in docs.collect()], [("x", t) for _, t in items])
    return [(a[0], h[1], a[2], a[3]) for a, h in zip(both, hits, strict=True)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_odd_rows(spark, odd_docs, block_bytes):
    assert sorted(found(spark, odd_docs, ITEMS, block_bytes=block_bytes)) == sorted(brute(odd_docs, ITEMS))


def test_random_texts(spark, monkeypatch):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(rng.randint(0, n)))
    docs = spark.createDataFrame([(i, text(80)) for i in range(60)], "doc_id long, text string")
    items = [(i, text(13)) for i in range(30)]
    assert sorted(found(spark, docs, items)) == sorted(brute(docs, items))


def test_no_rows_and_no_items(spark, odd_docs, no_docs):
    assert found(spark, no_docs, ITEMS) == []
    assert {r[1:3] for r in found(spark, odd_docs, [(1, None)])} == {(0, 0)}
    assert {r[1:3] for r in found(spark, odd_docs, [(1, None)][:0])} == {(0, 0)}


def test_passages_are_cut(spark, odd_docs):
    docs = odd_docs.withColumn("n_chars", F.length("text").cast("long"))
    joined = spark.createDataFrame([(50, "zeta eta two words theta iota kappa lambda mu nu xi omicron end", "en", "a", 0.0, 9)], docs.schema)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    clean = D.without_passages(docs.union(joined), bench)
    assert clean.columns == docs.columns
    assert D.contamination(clean, bench).where("n_hit > 0").count() == 0
    kept = {(r["doc_id"], r["text"]) for r in clean.collect()}
    assert (10, "before  pi rho after and then some more text") not in kept  # the second window takes these too
    assert (10, "before  after and then some more text") in kept
    # cutting one passage brings another together; it goes too
    assert (50, "  end") in kept or (50, " end") in kept
    assert {(r["doc_id"], r["text"]) for r in docs.where("doc_id in (2, 3, 4, 5, 6, 11, 12)").collect()} <= kept
    assert clean.where("n_chars <> length(text)").count() == 0


def test_block_size_does_not_change_what_is_cut(spark, odd_docs):
    w = [f"k{i}" for i in range(40)]
    items = [(i, " ".join(w[i : i + 10])) for i in range(0, 28, 3)] + [(90, "left joins right"), (91, "then this"), (92, "one"), (93, "after one")]
    texts = [" ".join(["in", *w, "out"]), " ".join(["in", *w[3:22], "out"]), "left " + " ".join(w[:10]) + " joins right", "then " * 4 + "this " * 4 + "end", "x after one, one! y", " ".join(w[:10] + w[12:22])]
    columns = "doc_id long, text string, lang string, source string, score double"
    docs = odd_docs.union(spark.createDataFrame([(100 + i, t, "en", "a", 0.0) for i, t in enumerate(texts)], columns))
    docs = docs.withColumn("n_chars", F.length("text").cast("long")).withColumnRenamed("source", "spans").withColumnRenamed("score", "n_hit")
    bench = spark.createDataFrame([*ITEMS, *items], "item_id long, text string")
    rows = lambda x: sorted((tuple(r) for r in x.collect()), key=str)
    whole, parts = D.without_passages(docs, bench), D.without_passages(docs, bench, block_bytes=40)
    assert D._n_blocks(bench, "text", 40) > 5 and D._n_blocks(bench, "text", D.BLOCK_BYTES) == 1
    assert parts.columns == docs.columns and parts.dtypes == docs.dtypes
    assert rows(parts) == rows(whole)
    kept = {r["doc_id"]: r["text"] for r in parts.collect()}
    assert kept[100] == "in  k37 k38 k39 out" and kept[102].split() == [] and kept[103] == " end"
    plain = docs.select("doc_id", "text")
    spans = [rows(D.contamination(plain, bench, block_bytes=b).select("doc_id", F.hex("spans"), "items", "n_hit")) for b in (40, D.BLOCK_BYTES)]
    assert spans[0] == spans[1]
    assert D.contamination(parts.select("doc_id", "text"), bench).where("n_hit > 0").isEmpty()


def test_one_block_at_a_time(spark, odd_docs, monkeypatch):
    steps, blocks, written = [], D._blocks, D.written

    def each(*a):
        for items in blocks(*a):
            steps.append("block")
            yield items

    monkeypatch.setattr(D, "_blocks", each)
    monkeypatch.setattr(D, "written", lambda *a: steps.append("written") or written(*a))
    got = sorted(found(spark, odd_docs, ITEMS, block_bytes=60))
    n = steps.count("block")
    assert n > 2 and steps == ["block"] + ["block", "written"] * (n - 1)
    assert got == sorted(brute(odd_docs, ITEMS))


def test_clashing_names(spark, odd_docs):
    with pytest.raises(ValueError):
        D.contamination(odd_docs.withColumn("spans", F.lit(1)), spark.createDataFrame(ITEMS, "item_id long, text string"))


def test_query(spark, sf_dir):
    names, rows = spark_bag(QUERIES["op2_decontamination"](spark, sf_dir))
    want_names, want, _ = duck_bag(SQL["op2_decontamination"], sf_dir)
    assert names == want_names and rows == want
