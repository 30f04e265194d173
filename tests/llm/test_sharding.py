import collections
import zlib

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import sharding
from eventloom.llm.queries import QUERIES


def check(rows, docs):
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    slots = collections.defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(8))
    for x in slots.values():
        assert sorted(x) == list(range(len(x)))
    counts = [len(slots[k]) for k in range(8)]
    assert max(counts) - min(counts) <= 1


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text")
    check(sharding.digest(docs).collect(), [tuple(r) for r in docs.collect()])
    assert sharding.digest(no_docs.select("doc_id", "text")).count() == 0


def test_many_buckets(spark, tmp_path):
    docs = spark.range(1000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text", "id as extra")
    first = sharding.sharded(docs, f"file://{tmp_path}/a", bucket_bytes=2000)
    again = sharding.sharded(docs.repartition(7), f"file://{tmp_path}/b", bucket_bytes=2000)
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "shard", "slot", "extra").collect())
    assert key(first) == key(again)  # whatever the partitions
    order = [r["doc_id"] for r in first.orderBy("slot", "shard").collect()]
    assert sorted(order) == list(range(1000)) and abs(np.corrcoef(order, range(1000))[0, 1]) < 0.15
    assert len(list(tmp_path.glob("a/shard=*"))) == 8


def test_a_flood_of_equal_rows_is_dealt_over_buckets(spark, tmp_path, monkeypatch):
    docs = spark.range(6000).selectExpr("if(id % 2 = 0, null, id) as doc_id", "if(id % 2 = 0, 'the same', repeat('y', cast(id % 50 as int))) as text")
    seen, plain = [], sharding._filled
    monkeypatch.setattr(sharding, "_filled", lambda *a: seen.append(plain(*a)) or seen[-1])
    rows = sharding.sharded(docs, f"file://{tmp_path}/a", bucket_bytes=8000)
    (before, held), (after, held_after) = seen
    assert before.sum() == after.sum() == 6000 and held.sum() == held_after.sum()
    assert before.max() >= 3000 and held_after.max() < 2.5 * 8000
    found = rows.collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in found) == collections.Counter(tuple(r) for r in docs.collect())
    assert sorted((r["shard"], r["slot"]) for r in found) == [(k, i) for k in range(8) for i in range(750)]
    in_order = [r["doc_id"] is None for r in sorted(found, key=lambda r: (r["slot"], r["shard"]))]
    assert all(abs(np.mean(x) - 0.5) < 0.15 for x in np.split(np.array(in_order), 10))  # copies lie everywhere


def test_every_bucket_is_a_task_of_its_own(spark, capsys):
    rows = spark.range(1000).selectExpr("cast(id % 13 as int) as bucket").repartitionById(13, "bucket")
    found = rows.groupBy("bucket").applyInArrow(lambda part: part.slice(0, 1), "bucket int")
    found.explain()
    assert capsys.readouterr().out.count("Exchange") == 1
    sizes = found.select(F.spark_partition_id().alias("at"), "bucket").collect()
    assert len({r["at"] for r in sizes}) == len(sizes) == 13


def test_fisher_yates_is_even():
    seen = collections.Counter(tuple(sharding.fisher_yates(3, 1, b)) for b in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert sharding.fisher_yates(0, 1, 1).tolist() == [] and sharding.fisher_yates(1, 1, 1).tolist() == [0]


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op4_sharding"](spark, sf_dir).collect(), docs)
