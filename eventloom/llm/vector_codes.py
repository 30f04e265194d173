"""Product-quantised codes of vectors, trained on integers, searched by a GNAT.

Components become ``floor(scale * x)``; a vector is cut into equal consecutive
parts, each part position has its own codebook, and a vector's code is the number of
the nearest entry per part. Codebooks start as the parts of the first vectors by id;
a training round assigns every part of every vector and moves each entry to the
floored mean of its parts. An entry's GNAT (``gnat``) finds the nearest entries
exactly; everything is whole numbers, so results do not depend on the order of rows.

A round is one pass over the table. What leaves a task is a sum and a count
per entry, summed per entry over all tasks; the driver and the tasks hold only the
codebooks: entries x components numbers, whatever the number of rows.

Defined cases: a vector that is null, empty, or holds a null or non-finite
component is dropped. So is no other; vectors of another length than the first, a length
that the parts do not divide, or components beyond ``LIMIT`` (their squares would leave
64 bits) stop the job with a message. Rows without an id come last when codebooks
start, rows of one id by their components; repeated rows count as often as they occur;
fewer rows than entries give fewer entries. Null labels are one label. An empty table gives an
empty table. Other columns are not looked at, so they may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm import gnat
from eventloom.llm.common import written
from eventloom.operators.joins import hot_key_join

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Largest component after scaling, either way; 2**12 components of this size still sum up in 64 bits.
LIMIT = 1 << 24
#: Vectors that are searched at a time.
BATCH = 8192


@dataclass
class Codebooks:
    """Per part position its entries as rows of whole numbers."""

    entries: list[np.ndarray]

    def trees(self) -> list[gnat.Node]:
        return [gnat.build(e) for e in self.entries]

    def sha256(self) -> str:
        """Digest of all components as decimals, by part, entry and place."""
        numbers = ",".join(str(x) for part in self.entries for x in part.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def _finite(vector: str) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & good


def _whole(vectors: pa.Array, scale: int, dimension: int) -> np.ndarray:
    """Scaled components as whole numbers, one row per vector."""
    lengths = np.diff(vectors.offsets.to_numpy())
    if (lengths != dimension).any():
        raise ValueError(f"vectors of {dimension} and of {lengths[lengths != dimension][0]} components")
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(flat) and np.abs(flat).max() > LIMIT:
        raise ValueError(f"a scaled component is beyond {LIMIT}; its squares would leave 64 bits")
    return flat.astype(np.int64).reshape(len(vectors), dimension)


def _blocks(batches: Iterator[pa.RecordBatch], vector: str, scale: int, dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, BATCH):
            piece = batch.slice(i, BATCH)
            yield piece, _whole(piece.column(vector), scale, dimension)


def first_codebooks(rows: DataFrame, *, vector: str, row_id: str, parts: int, entries: int, scale: int) -> Codebooks | None:
    """The parts of the ``entries`` first vectors by id; None without any."""
    first = rows.orderBy(F.col(row_id).asc_nulls_last(), vector).limit(entries).select(vector).toArrow()
    if not first.num_rows:
        return None
    vectors = first.column(0).combine_chunks()
    dimension = len(vectors[0])
    if dimension % parts:
        raise ValueError(f"{dimension} components cannot be cut into {parts} equal parts")
    whole = _whole(vectors, scale, dimension)
    return Codebooks([np.ascontiguousarray(p) for p in np.split(whole, parts, axis=1)])


def _sums(books, vector: str, scale: int):
    """For mapInArrow: per part and entry the sum and number of the parts nearest to it."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Codebooks = books.value
        trees, width = model.trees(), model.entries[0].shape[1]
        sums = [np.zeros((len(e), width + 1), np.int64) for e in model.entries]
        for _, whole in _blocks(batches, vector, scale, width * len(trees)):
            for part, tree in enumerate(trees):
                queries = whole[:, part * width : (part + 1) * width]
                found, _ = gnat.nearest(tree, model.entries[part], queries)
                np.add.at(sums[part], found, np.column_stack([queries, np.ones(len(found), np.int64)]))
        for part, table in enumerate(sums):
            used = np.flatnonzero(table[:, -1])
            for place in range(width):
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": np.full(len(used), part, np.int32),
                        "entry": used.astype(np.int32),
                        "place": np.full(len(used), place, np.int32),
                        "total": table[used, place],
                        "n": table[used, -1],
                    }
                )

    return of


def trained(rows: DataFrame, books: Codebooks, *, vector: str, scale: int) -> Codebooks:
    """One round: every part to its nearest entry, every used entry to its floored mean."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(books)
    kinds = "part int, entry int, place int, total long, n long"
    sums = rows.select(vector).mapInArrow(_sums(shared, vector, scale), kinds).groupBy("part", "entry", "place")
    # whole numbers of any size: a sum over all rows may pass 64 bits
    found = sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    shared.destroy()
    moved = [e.copy() for e in books.entries]
    for r in found:
        moved[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(moved)


def _codes(books, vector: str, scale: int, keep: list[str]):
    """For mapInArrow: the kept columns with code and squared error of each vector."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Codebooks = books.value
        trees, width = model.trees(), model.entries[0].shape[1]
        for piece, whole in _blocks(batches, vector, scale, width * len(trees)):
            code, error = np.empty((len(whole), len(trees)), np.uint8), np.zeros(len(whole), np.int64)
            for part, tree in enumerate(trees):
                code[:, part], distance = gnat.nearest(tree, model.entries[part], whole[:, part * width : (part + 1) * width])
                error += distance
            columns = [piece.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([row.tobytes() for row in code]), pa.array(error)], names=[*keep, "code", "error"])

    return of


def fitted(
    vectors: DataFrame,
    *,
    vector: str = "embedding",
    row_id: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks from all vectors that take part; None when there are none."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte per part")
    rows = vectors.where(_finite(vector)).select(row_id, vector)
    books = first_codebooks(rows, vector=vector, row_id=row_id, parts=parts, entries=entries, scale=scale)
    for _ in range(rounds if books else 0):
        books = trained(rows, books, vector=vector, scale=scale)
    return books


def coded(
    vectors: DataFrame, books: Codebooks | None, *, vector: str = "embedding", row_id: str = "vec_id", keep: tuple[str, ...] = (), scale: int = SCALE
) -> DataFrame:
    """Id, kept columns, ``code`` (one byte per part) and ``error`` of every vector that takes part.

    Kept columns may not be called code, error or vector_in.
    """
    spark, names = vectors.sparkSession, [row_id, *keep]
    if {"code", "error", "vector_in"} & set(names):
        raise ValueError("rename kept columns code, error and vector_in first")
    kinds = vectors.select(*names).schema.add("code", "binary").add("error", "long")
    if books is None:
        return spark.createDataFrame([], kinds)
    shared = spark.sparkContext.broadcast(books)
    rows = vectors.where(_finite(vector)).select(*names, F.col(vector).alias("vector_in"))
    return rows.mapInArrow(_codes(shared, "vector_in", scale, names), kinds)


def decoded(codes: DataFrame, books: Codebooks, *, scale: int = SCALE, code: str = "code", vector: str = "approximate") -> DataFrame:
    """Adds the vector that a code stands for, from the entries' whole numbers."""
    table = F.array(*[F.array(*[F.array(*[F.lit(x / scale) for x in entry]) for entry in part.tolist()]) for part in books.entries])
    number = lambda i: F.conv(F.hex(F.substring(code, i + F.lit(1), F.lit(1))), 16, 10).cast("int")
    parts = F.sequence(F.lit(0), F.lit(len(books.entries) - 1))
    return codes.withColumn(vector, F.flatten(F.transform(parts, lambda i: F.get(F.get(table, i), number(i)))))


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's columns: code in hex, error, its sum per label, digest of the codebooks."""
    books = fitted(vectors)
    clean = vectors.select("vec_id", "embedding", "label")
    rows = written(coded(clean, books, keep=("label",)), "vector-codes")
    # a null label is a label, so the join goes by a key that is never null
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("label_key")
    sums = rows.groupBy(key).agg(F.sum("error").alias("label_error"))
    found = hot_key_join(rows.withColumn("label_key", key), sums, "label_key", spread_by=["vec_id"])
    return found.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"),
    )
