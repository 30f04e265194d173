"""The manifest against a plain version, on every shape of ids and groups."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def a_to_z(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """Levels from the nodes up to one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 8 * 8
        out.append((level[run:i], level[i + 1 : run + 8]))
        i //= 8
    return out


def plain(rows):
    """Rows of the contract as a multiset."""
    groups = defaultdict(list)
    for r in rows:
        leaf = h(*map(field, r))
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        changed = h(*map(field, r[:4]), field(a_to_z(r[4]))) if tampered else leaf
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf, changed, r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort()
        trees[g] = climb([x[2] for x in groups[g]])
    top = climb([trees[g][-1][0] for g in order])
    out = Counter()
    for place, g in enumerate(order):
        for i, (_, _, leaf, changed, doc_id) in enumerate(groups[g]):
            path = way(trees[g], i) + way(top, place)
            node = changed
            for a, b in path:
                node = h(*a, node, *b)
            proof = h(*[x for a, b in path for x in (*a, *b)])
            out[doc_id, leaf, trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]] += 1
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3, F.rand(1))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in merkle.digest(df).select(*names).collect()) == plain(rows)


def test_many_levels_and_groups(spark):
    rng = random.Random(1)
    rows = [(i, f"s{i % 7}", rng.choice(["en", "de", "zz", None]), i, f"Text {i} É") for i in rng.sample(range(50_000), 5000)]
    check(spark, rows)


def test_dense_bitmaps_with_repeats(spark):
    # one bitmap of more than SPARSE ids, some of which occur several times with other texts
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(2600)]
    rows += [(i, "s", "en", 1, f"Other {i} {j}") for i in range(0, 2600, 90) for j in range(3)]
    rows += [(17, "s", "en", 1, "Text 17")] * 5
    check(spark, rows)


def test_odd_ids_nulls_and_copies(spark):
    far = [-(2**63), 2**63 - 1, -1, 0, 2**40, 2**40 + 1]
    rows = [(i, None, None, None, None) for i in far]
    rows += [(None, "s", lang, None, f"no id {j}") for lang in ("en", None) for j in range(9)]
    rows += [(5, "s", "en", 3, "Copy")] * 40 + [(6, "", "", 0, "")] + [(6, None, "", 0, None)]
    rows += [(7, "s", "one row", 1, "X" * 300_000)]
    check(spark, rows)


def test_one_row_and_one_group(spark):
    check(spark, [(3, "a", "en", 1, "Only")])
    check(spark, [(i, "a", None, 1, "T") for i in range(9)])


def test_a_third_of_all_rows_under_one_id(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 64)
    rows = [(11, "s", "en", 1, f"T{i % 700}") for i in range(1500)] + [(i, "s", "en", 1, f"U{i}") for i in range(1500)]
    check(spark, rows)


def test_bitmaps_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    check(spark, [(i * 40_000, "s", "en" if i % 3 else "de", 1, f"T{i}") for i in range(500)])


def test_long_bitmap_numbers_take_several_digits(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DIGIT_BITS", 2)
    check(spark, [(i * 30_011, "s", "en", 1, f"T{i}") for i in range(300)] + [(None, "s", "en", 1, "n")])


def test_clashing_and_extra_columns(spark, odd_docs):
    more = odd_docs.withColumns({"n_chars": F.length("text").cast("long"), "grp": F.lit(1), "leaf": F.lit("x"), "slot": F.lit(2)})
    rows = [tuple(r) for r in more.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(tuple(r) for r in merkle.digest(more).select(*names).collect()) == plain(rows)


def test_empty_table_and_other_ids(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle.digest(none).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(none.withColumn("doc_id", F.lit("x")))


def test_tampering_is_found(spark):
    rows = [(i, "s", "en", 1, "UPPER case") for i in range(100)]
    found = merkle.digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"] for r in found if not r["verified"]} == {i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 0}
