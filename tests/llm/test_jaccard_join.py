import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import jaccard_join as J
from eventloom.llm.components import components
from eventloom.llm.queries import QUERIES
from eventloom.llm.t_occurrence import InvertedIndex, occurring


def test_occurring():
    rng = random.Random(4)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randint(1, 20))) for _ in range(rng.randint(0, 25))]
        count = collections.Counter(x for y in lists for x in y)
        for least in (1, 2, 5, 12):
            assert occurring(lists, least) == {k: v for k, v in count.items() if v >= least}


def test_linked():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint64)) for _ in range(60)]
    index = InvertedIndex(sets)
    for q in sets:
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 75 * len(np.union1d(q, s))]
        assert index.linked(q, 75) == want
    assert InvertedIndex([]).linked(sets[0], 75) == []


def brute(rows):
    """doc_id -> (size, least id reachable); rows with one id are one document for components."""
    sets = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((doc, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    parent = {doc: doc for doc, _ in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = collections.defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, (doc, s) in enumerate(sets):
        for j, shared in collections.Counter(j for x in s for j in holders[x] if j < i).items():
            if doc is not None and sets[j][0] is not None and 100 * shared >= 75 * (len(s) + len(sets[j][1]) - shared):
                a, b = root(doc), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return sorted(((doc, len(s), root(doc)) for doc, s in sets), key=str)


def got(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(J.joined(odd_docs)) == brute(rows)


def test_no_rows(spark, no_docs):
    assert got(J.joined(no_docs)) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_groups_and_shared_passages(spark, seed, monkeypatch):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 90))] + passage * (rng.random() < 0.4)
        for _ in range(rng.choice([1, 1, 2, 3, 12])):
            copy = [word() if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else w for w in base]
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
            if rng.random() < 0.3:  # a chain: the copy's copies drift away
                base = copy
    rows = [*{r[0]: r for r in rows}.values()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(J.joined(docs)) == brute(rows)


def test_one_of_each(spark, odd_docs):
    kept = J.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(kept.select("doc_id").toPandas()["doc_id"].dropna().astype(int)) == [1, 2, 3, 4, 5, 6, 8, 10, 12]
    assert kept.where("doc_id is null").count() == 1


def test_one_of_each_keeps_rows_without_id_beside_a_repeated_id(spark):
    text = lambda i: " ".join(f"t{i}w{k}" for k in range(12))
    rows = [(1, text(1), "b"), (1, text(1), "a"), (1, text(1), "a"), (1, text(2), "c"), (1, None, "d"), (1, "", "e"), (2, text(1), "f"), (3, text(3), "g")]
    rows += [(None, text(i), "n") for i in (1, 4, 5, 5)] + [(None, None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = [(1, text(1), "a"), (1, text(2), "c"), (1, None, "d"), (1, "", "e"), (3, text(3), "g"), *rows[8:]]
    for given in (docs, docs.repartition(7), docs.orderBy(F.desc("lang"))):
        kept = J.one_of_each(given)
        assert kept.columns == docs.columns
        assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, 8), (8, 7)]
    rows = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["key"]: r["component"] for r in rows} == {**{i: 100 for i in range(100, 161)}, 7: 7, 8: 7}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op9_jaccard_join"](spark, sf)) == brute(rows)
