"""Nearest vectors by inner product through a forest of random-projection trees.

The forest is grown on the driver from at most ``SAMPLE_ROWS`` vectors, in hash
order; every row is then indexed: each tree sends it to one leaf. Vectors get one
more dimension so that the largest inner product is the smallest distance. A query
walks all trees through one shared priority queue, nearest planes first, until
the leaves it has reached hold ``VISITED`` times the number of ids. A row counts there
as its share of its id's rows, so an id weighs at most one in each tree and the
leaves reached hold at least four times as many ids as are asked for, if there are
so many. Queries meet
the rows of their leaves in blocks of bounded size, dealt by id and vector, are
scored exactly there, and keep the best ids of each block; the best over all blocks
is the result.

With no structure in the vectors a recall of 0.9 needs about half of all rows,
which the default gives; clustered vectors need far fewer.

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, nor do rows without an id. Rows that
share an id count once, with their best score; rows equal in id and vector are
merged before the forest is grown. Equal scores go to smaller ids. An empty table
gives no rows; other columns are not read, so their names cannot clash, and there are no
texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import written
from eventloom.llm.rp_forest import grow, search
from eventloom.operators.joins import hot_key_join

TREES = 12
#: Leaves a tree is grown to, about.
LEAVES = 96
SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 64 << 20
#: Ids in the leaves a query reaches, as a share of all ids; an id counts once for each tree.
VISITED = 0.85
NEIGHBOURS = 20
ROW_BLOCK, QUERY_BLOCK = 4096, 4096
SEED = 11

_MET = "leaf long, block long, turn long, is_query boolean, id long, vector array<double>"


def usable(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """id and vector (double) of the rows that take part, and their length."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(finite & some)
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    return rows.where(F.size("vector") == d), d


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _longer(points: np.ndarray, most: float) -> np.ndarray:
    """One more dimension that gives all points the same length."""
    rest = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", points, points), 0))
    return np.concatenate((points, rest[:, None]), 1)


class Forest:
    def __init__(self, points: np.ndarray, most: float, trees: int, leaves: int, seed: int):
        rng, self.most = np.random.default_rng(seed), most
        points = _longer(points, most)
        self.trees = [grow(points, max(2, -(-len(points) // leaves)), rng) for _ in range(trees)]
        self.first = np.cumsum([0] + [t.leaves for t in self.trees])  # leaves are numbered through

    def leaves_of(self, points: np.ndarray) -> np.ndarray:
        points = _longer(points, self.most)
        return np.stack([t.leaf_of(points) + f for t, f in zip(self.trees, self.first[:-1], strict=True)], 1)


def _count_leaves(shared, d: int):
    def of(batches):
        forest = shared.value
        total, weight = np.zeros(forest.first[-1], np.int64), np.zeros(forest.first[-1])
        for batch in batches:
            leaves = forest.leaves_of(_matrix(batch.column(0), d))
            share = np.repeat(1 / batch.column(1).to_numpy(zero_copy_only=False), leaves.shape[1])
            total += np.bincount(leaves.reshape(-1), minlength=len(total))
            weight += np.bincount(leaves.reshape(-1), share, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at]), pa.array(weight[at])], names=["leaf", "rows", "weight"])

    return of


def _find_leaves(shared, d: int, weight_in: np.ndarray, enough: int):
    def of(batches):
        forest = shared.value
        counts = [weight_in[a:b] for a, b in zip(forest.first[:-1], forest.first[1:], strict=True)]
        for batch in batches:
            points = _matrix(batch.column(1), d)
            zero = np.concatenate((points, np.zeros((len(points), 1))), 1)
            found = [[int(forest.first[k] + leaf) for k, leaf in search(forest.trees, p, counts, enough)] for p in zero]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["id", "vector", "leaves"])

    return of


def _deal(shared, d: int, blocks: np.ndarray, turns: np.ndarray, query: bool):
    """Rows go to one block of each leaf and all its turns; queries to one turn and all blocks."""

    def of(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            spread = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(33)
            if query:
                leaf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(ids)), np.diff(batch.column(3).offsets.to_numpy()))
            else:
                leaves = shared.value.leaves_of(_matrix(batch.column(1), d))
                leaf, row = leaves.reshape(-1), np.repeat(np.arange(len(ids)), leaves.shape[1])
            own, all_of = (turns, blocks) if query else (blocks, turns)
            fixed = spread[row].astype(np.int64) % np.maximum(own[leaf], 1)
            many = all_of[leaf]
            each = np.repeat(np.arange(len(leaf)), many)
            other = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
            for lo in range(0, len(each), 8192):
                e, o = each[lo : lo + 8192], other[lo : lo + 8192]
                block, turn = (o, fixed[e]) if query else (fixed[e], o)
                columns = [leaf[e], block, turn, np.full(len(e), query), ids[row[e]]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), batch.column(1).take(pa.array(row[e]))], names=[x.split()[0] for x in _MET.split(", ")])

    return of


def _rank(d: int, k: int):
    """For applyInArrow: the best ids of one block for the queries of one turn, each with its best score."""

    def of(part: pa.Table) -> pa.Table:
        is_query = part.column("is_query").to_numpy()
        ids = part.column("id").to_numpy()
        points = _matrix(part.column("vector").combine_chunks(), d)
        rows, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        first = np.flatnonzero(np.diff(ids[rows], prepend=ids[rows[:1]] - 1)) if len(rows) else rows  # of each id
        out: list[tuple] = []
        for lo in range(0, len(queries), 512):
            some = queries[lo : lo + 512]
            near = points[some] @ points[rows].T
            near[ids[some][:, None] == ids[rows]] = -np.inf
            # by the fast product a little more than needed; then the exact sum, whose order is fixed
            each = near if len(first) == len(rows) else np.maximum.reduceat(near, first, axis=1)
            cut = np.partition(each, -k, axis=1)[:, -k] if len(first) > k else np.full(len(some), -np.inf)
            cut = cut - 1e-9 * (1 + np.abs(np.where(np.isfinite(cut), cut, 0)))
            for i, q in enumerate(some):
                at = rows[np.flatnonzero((near[i] >= cut[i]) & np.isfinite(near[i]))]
                score = (points[at] * points[q]).sum(1)
                best = np.lexsort((ids[at], -score))
                best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])[:k]]
                out.append((np.full(len(best), ids[q]), ids[at][best], score[best]))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return of


def nearest(vectors: DataFrame, is_query, *, key: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS, trees: int = TREES, leaves: int = LEAVES, visited: float = VISITED, sample: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row for which ``is_query(id)`` holds."""
    spark = vectors.sparkSession
    rows, d = usable(vectors, key=key, vector=vector)
    if not d:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = written(rows.dropDuplicates(["id", "vector"]).withColumn("spread", F.xxhash64("id", "vector")), "vectors")
    repeated = written(rows.groupBy("id").agg(F.count("*").alias("of_id")).where("of_id > 1"), "repeated")
    if repeated.isEmpty():
        rows = rows.withColumn("of_id", F.lit(1).cast("long"))
    else:
        rows = hot_key_join(rows, repeated, "id", how="left", spread_by=["spread"]).withColumn("of_id", F.coalesce("of_id", F.lit(1)))
        rows = written(rows, "weighed")
    total = rows.agg(F.round(F.sum(1 / F.col("of_id"))).alias("ids"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)).alias("most")).first()
    taken = rows.orderBy("spread", "id", "vector").limit(max(2, min(sample, SAMPLE_BYTES // (8 * d)))).select("vector").toArrow()
    forest = spark.sparkContext.broadcast(Forest(_matrix(taken.column(0).combine_chunks(), d), total["most"], trees, leaves, seed))
    rows_in, weight_in = np.zeros(forest.value.first[-1], np.int64), np.zeros(forest.value.first[-1])
    filled = rows.select("vector", "of_id").mapInArrow(_count_leaves(forest, d), "leaf long, rows long, weight double")
    # weights in 1/2^20, so that their sum does not depend on the order of tasks
    for r in filled.groupBy("leaf").agg(F.sum("rows").alias("rows"), F.sum(F.round(F.col("weight") * (1 << 20)).cast("long")).alias("weight")).collect():
        rows_in[r["leaf"]], weight_in[r["leaf"]] = r["rows"], r["weight"] / (1 << 20)  # one row per leaf of the forest
    enough = max(4 * k * trees, visited * total["ids"])
    queries = rows.select("id", "vector").where(is_query(F.col("id")))
    walked = written(queries.repartition(spark.sparkContext.defaultParallelism).mapInArrow(_find_leaves(forest, d, weight_in, enough), "id long, vector array<double>, leaves array<long>"), "walks")
    walked = walked.select("id", "vector", F.xxhash64("id", "vector").alias("spread"), "leaves")
    asked = np.zeros(len(rows_in), np.int64)
    for r in walked.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():
        asked[r["leaf"]] = r["count"]
    blocks, turns = -(-rows_in // ROW_BLOCK), -(-asked // QUERY_BLOCK)
    met = rows.drop("of_id").mapInArrow(_deal(forest, d, blocks, turns, False), _MET).union(walked.mapInArrow(_deal(forest, d, blocks, turns, True), _MET))
    best = met.groupBy("leaf", "block", "turn").applyInArrow(_rank(d, k), "query_id long, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
