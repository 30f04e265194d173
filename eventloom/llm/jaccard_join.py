"""Links between documents whose word shingles overlap, and their components.

Two documents link when 100 * intersection >= 75 * union of their sets of
distinct five-word shingles (64-bit hashes). All links count; none is found by
chance. The steps:

1. One pass over the texts gives each document its set's size and digest.
   Equal sets are one node from then on. The pass also sends every shingle, 32
   bits of it, to its bucket: a node can only link if three quarters of its
   shingles occur in another node too. Cut hashes may keep a node too many,
   never lose one. A shingle that several nodes of a chunk share is sent once
   per chunk, so no bucket gathers a frequent one. A bucket knows a node by its
   place in its chunk alone, so equal nodes of several chunks count as sharing.
2. The few nodes that are left get their whole sets. Nodes that link must share
   one of the first ``n - ceil(0.75 n) + 1`` shingles in one common order, rare
   ones first; these are the nodes' lists.
3. Each list has a leader, the node with the largest share of frequent shingles:
   of a text and its copies that is the text. A leader's cluster is all nodes that
   have a list of it. Each node is searched against the two leaders with which it
   shares most lists; what links is a component from then on.
4. Nodes that link meet in a cluster. In each cluster that still has several
   components, all nodes outside the largest one are searched against the
   cluster, in square blocks of bounded size.

A search takes nodes as queries and a block of sets as index: T-occurrence by
DivideSkip (see ``t_occurrence``).

Defined cases: no words or a null text: an empty set, linked with nothing,
component of its own. Fewer than five words: the whole sequence is one shingle.
Rows without an id have no component of their own (null). Rows with one id are
one document for components. Very long texts are taken whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import release_memory, tasks_for, text_bytes, written
from eventloom.llm.components import components
from eventloom.llm.t_occurrence import InvertedIndex
from eventloom.llm.words import NOT_SPACE, buffer_of, row_blocks, shingles_of, words_of

SHINGLE_WORDS = 5
PERCENT = 75
#: Text bytes that a task turns into postings at once; about a sixth as many words.
CHUNK_BYTES = 6 << 20
#: Postings that meet in one bucket, about.
BUCKET_POSTINGS = 2 << 20
#: Frequent shingles whose counts are handed to every task, to put rare ones first.
ORDERED = 1 << 19
#: Sets in one block of an index, and queries that come to it.
BLOCK_SETS = 256
#: Node ids that may be broadcast.
BROADCAST_NODES = 1 << 20

_PARTS = "bucket int, doc_id long, node binary, n int, own int, key long, dup long, chunk long, keys binary, hashes binary, docs binary"
_COUNTS = "doc_id long, node binary, n int, own int, key long, dup long, chunk long, keys binary, docs binary, dups binary"
_ZSTD = pa.Codec("zstd", compression_level=1)


def _sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, ascending."""
    hashes, splits = shingles_of(words_of(data, offsets, NOT_SPACE), SHINGLE_WORDS)
    return [np.unique(hashes[splits[i] : splits[i + 1]]) for i in range(len(offsets) - 1)]


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers, compressed; the bytes of each significance stand together."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(values).to_bytes(8, "little") + _ZSTD.compress(planes.tobytes(), asbytes=True)


def _unpacked(value: bytes, kind: str) -> np.ndarray:
    n = int.from_bytes(value[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(value[8:], decompressed_size=4 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view(kind)


def _postings(bits: int):
    """For mapInArrow: a row for each document, and of each chunk its nodes' keys and packed
    postings for each bucket."""
    top, names = np.uint64(64 - bits), [x.split()[0] for x in _PARTS.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    schema, buckets = pa.schema(list(zip(names, kinds, strict=True))), 1 << bits

    def rows(ids, data, offsets):
        sets = _sets(data, offsets)
        digests = [_digest(s) if len(s) else None for s in sets]
        at = {}  # the first document of each node
        for i, d in enumerate(digests):
            if d is not None:
                at.setdefault(d, i)
        for i, (doc, d) in enumerate(zip(ids, digests, strict=True)):
            own = int(d is not None and at[d] == i)
            yield i % buckets, doc, d, len(sets[i]), own, None if d is None else _key(d), None, None, None, None, None
        firsts = list(at.values())
        if not firsts:
            return
        keys = np.array([_key(digests[i]) for i in firsts], "<i8")
        chunk = _key(_digest(keys))
        yield chunk % buckets, None, None, None, None, None, None, chunk, keys.tobytes(), None, None
        hashes = np.concatenate([sets[i] for i in firsts])
        local = np.repeat(np.arange(len(firsts)), [len(sets[i]) for i in firsts])
        order = np.argsort(hashes, kind="stable")
        hashes, local = hashes[order], local[order]
        fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
        alone = fresh & np.concatenate((fresh[1:], [True]))
        dup = np.bincount(local[~alone], minlength=len(firsts))
        for k in np.flatnonzero(dup):
            yield int(k) % buckets, None, None, None, None, int(keys[k]), int(dup[k]), None, None, None, None
        # a shingle that several nodes of this chunk share goes on once, as nobody's (0; nodes count from 1)
        hashes, local = hashes[fresh], np.where(alone, local + 1, 0)[fresh]
        cuts = np.searchsorted(hashes >> top, np.arange(buckets + 1, dtype=np.uint64))
        short = ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        for b in range(buckets):
            lo, hi = cuts[b], cuts[b + 1]
            if hi > lo:
                yield b, None, None, None, None, None, None, chunk, None, _packed(np.diff(short[lo:hi], prepend=np.uint32(0))), _packed(local[lo:hi])

    def of(batches):
        release_memory()
        for batch in batches:
            data, offsets = buffer_of(batch.column(1))
            for a, b in row_blocks(offsets, CHUNK_BYTES):
                out = list(zip(*rows(batch.column(0).slice(a, b - a).to_pylist(), data, offsets[a : b + 1]), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], schema=schema)

    return of


def _shared(part: pa.Table) -> pa.Table:
    """One bucket: how many shingles of each chunk's nodes another node has as well."""
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip([x.split()[0] for x in _COUNTS.split(", ")], kinds, strict=True)))
    packed = part.column("hashes").is_valid()
    plain = part.filter(pc.invert(packed))
    out = [pa.Table.from_arrays([*(plain.column(c) for c in schema.names[:8]), *(pa.nulls(len(plain), k) for k in kinds[8:])], schema=schema)]
    part = part.filter(packed).select(["chunk", "hashes", "docs"])
    if len(part):
        lengths = [int.from_bytes(x.as_py()[:8], "little") for x in part.column("hashes")]
        value, owner = np.empty(sum(lengths), np.uint32), np.empty(sum(lengths), np.int32)
        base, at = [0], 0
        for i, n in enumerate(lengths):
            value[at : at + n] = np.cumsum(_unpacked(part.column("hashes")[i].as_py(), "<u4"), dtype=np.uint32)
            local = _unpacked(part.column("docs")[i].as_py(), "<i4")
            owner[at : at + n] = np.where(local > 0, local + (base[-1] - 1), -1)
            base.append(base[-1] + int(local.max()))
            at += n
        chunks = part.column("chunk").to_pylist()
        del part
        order = np.argsort(value, kind="stable").astype(np.int32)
        value, owner = value[order], owner[order]
        del order
        start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        del value
        least = np.minimum.reduceat(owner, start)
        several = (least != np.maximum.reduceat(owner, start)) | (least < 0)
        several = np.repeat(several, np.diff(np.append(start, len(owner))))
        dup = np.bincount(owner[several & (owner >= 0)], minlength=base[-1])
        found = [(chunk, np.flatnonzero(dup[a:b]), dup[a:b]) for chunk, a, b in zip(chunks, base, base[1:], strict=False)]
        found = [(chunk, met, many[met]) for chunk, met, many in found if len(met)]
        columns = [*(pa.nulls(len(found), k) for k in kinds[:6]), pa.array([x[0] for x in found], pa.int64()), pa.nulls(len(found), pa.binary())]
        columns += [pa.array([x[i].astype("<i4").tobytes() for x in found], pa.binary()) for i in (1, 2)]
        out.append(pa.Table.from_arrays(columns, schema=schema))
    return pa.concat_tables(out)


def _summed(part: pa.Table) -> pa.Table:
    """One chunk: the counts of its nodes over all buckets. Chunks of equal nodes are one, with both counts."""
    keys = np.frombuffer(next(k for k in part.column("keys").to_pylist() if k is not None), "<i8")
    join = lambda c: np.frombuffer(b"".join(x for x in part.column(c).to_pylist() if x is not None), "<i4")
    dup = np.bincount(join("docs"), join("dups"), len(keys)).astype(np.int64)
    return pa.table({"key": pa.array(keys[dup > 0], pa.int64()), "dup": pa.array(dup[dup > 0], pa.int64())})


def _whole_sets(batches):
    """For mapInArrow: node key, size and hashes of each text that has words."""
    for batch in batches:
        data, offsets = buffer_of(batch.column(0))
        for a, b in row_blocks(offsets, CHUNK_BYTES):
            sets = [s for s in _sets(data, offsets[a : b + 1]) if len(s)]
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array([_key(d) for d in digests], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "key", "n", "hashes"],
            )


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _first_shingles(frequent):
    """For mapInArrow: the shingles of each node that a partner must share one of."""

    def of(batches):
        hot, count = frequent.value
        for batch in batches:
            keys, sizes, shares, hashes = [], [], [], []
            for key, n, packed in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "hashes")), strict=True):
                h = np.frombuffer(packed, "<u8")
                weight = np.ones(n, np.int64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                    weight = np.where(hot[at] == h, count[at], 1)
                first = np.lexsort((h, weight))[: n - -(-PERCENT * n // 100) + 1]
                hashes.append(h[first].view(np.int64))
                keys.append(np.full(len(first), key))
                sizes.append(np.full(len(first), n))
                shares.append(np.full(len(first), int(1000 * (weight > 1).mean())))
            joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, keys, sizes, shares)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in joined], names=["shingle", "key", "n", "share"])

    return of


def _counted(batches):
    """For mapInArrow: shingles and in how many sets of this batch each occurs."""
    for batch in batches:
        packed = batch.column(0).to_pylist()
        value, count = np.unique(np.frombuffer(b"".join(packed), "<u8"), return_counts=True)
        several = count >= 2  # the others cannot be frequent
        yield pa.RecordBatch.from_arrays([pa.array(value[several].view(np.int64)), pa.array(count[several], pa.int64())], names=["shingle", "count"])


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``ORDERED`` of the most frequent shingles with counts, for the order only."""
    counts = sets.select("hashes").mapInArrow(_counted, "shingle long, count long").groupBy("shingle").agg(F.sum("count").alias("count"))
    counts = counts.where("count >= 4").persist(StorageLevel.DISK_ONLY)
    steps = counts.groupBy(F.floor(F.log2("count") * 4).cast("int").alias("step")).count().orderBy(F.desc("step")).collect()
    least, total = None, 0
    for row in steps:
        total += row["count"]
        if total > ORDERED:
            break
        least = row["step"]
    if least is None:
        counts.unpersist()
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = counts.where(F.floor(F.log2("count") * 4) >= least).toArrow()
    counts.unpersist()
    shingle = found.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], found.column("count").to_numpy()[order]


def _search(part: pa.Table) -> pa.Table:
    """The queries of one block against its index; one link is enough between two components."""
    index, queries = [], []
    for is_query, *row in zip(*(part.column(c).to_pylist() for c in ("is_query", "key", "component", "hashes")), strict=True):
        (queries if is_query else index).append((row[0], row[1], np.frombuffer(row[2], "<u8")))
    index.sort(key=lambda x: x[0])
    lists = InvertedIndex([x[2] for x in index])
    merged: dict[int, int] = {}

    def root(c):
        while c in merged:
            c = merged[c]
        return c

    a, b = [], []
    for key, component, query in sorted(queries, key=lambda x: x[0]):
        mine = root(component)
        if all(root(x[1]) == mine for x in index):
            continue
        for i in lists.linked(query, PERCENT):
            if (other := root(index[i][1])) != mine:
                a.append(key)
                b.append(index[i][0])
                merged[max(mine, other)] = min(mine, other)
                mine = min(mine, other)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links(queries: DataFrame, index: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the queries and the index of each cluster.

    Both have cluster, key, component. The index comes in blocks, the queries in
    turns; each row meets every row of the other side of its cluster once.
    """
    size = lambda rows, name: rows.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_SETS).alias(name))
    sizes = size(index, "blocks").join(size(queries, "turns"), "cluster")
    own = lambda many: F.pmod(F.xxhash64("key"), F.col(many))
    every = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.col(many) - 1))
    columns = ["cluster", "block", "turn", "is_query", "key", "component"]
    left = index.join(sizes, "cluster").withColumn("block", own("blocks")).withColumn("turn", every("turns")).withColumn("is_query", F.lit(False))
    right = queries.join(sizes, "cluster").withColumn("turn", own("turns")).withColumn("block", every("blocks")).withColumn("is_query", F.lit(True))
    met = left.select(columns).union(right.select(columns)).join(sets.select("key", "hashes"), "key")
    return met.groupBy("cluster", "block", "turn").applyInArrow(_search, "a long, b long")


def nodes_of(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document (node, key, n), and counts of shared shingles per node or, packed, per chunk; as written."""
    postings = max(1, text_bytes(docs, text) // 6)
    bits = max(1, (tasks_for(docs.sparkSession, postings, BUCKET_POSTINGS) - 1).bit_length())
    parts = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_postings(bits), _PARTS)
    return written(parts.groupBy("bucket").applyInArrow(_shared, _COUNTS), "nodes")


def joined(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document row."""
    counts = nodes_of(docs, doc, text)
    summed = counts.where("chunk is not null").select("chunk", "keys", "docs", "dups").groupBy("chunk").applyInArrow(_summed, "key long, dup long")
    dups = counts.where("dup is not null").select("key", "dup").union(summed).groupBy("key").agg(F.sum("dup").alias("dup"))
    nodes = counts.where("node is not null").groupBy("node", "key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.sum("own").alias("own"))
    nodes = written(nodes, "reps")
    # copies in several chunks have been counted once in each
    able = nodes.join(dups, "key").where(F.col("rep").isNotNull() & (F.col("dup") * 100 >= F.col("n") * PERCENT * F.col("own"))).select("node", "rep")
    sets = written(_sets_of(docs, written(able, "able"), doc, text), "sets")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(sets))
    lists = written(sets.select("key", "n", "hashes").mapInArrow(_first_shingles(frequent), "shingle long, key long, n long, share long"), "lists")
    frequent.destroy()
    members = written(_clusters(lists), "clusters")
    stars = written(_stars(members, sets), "stars")
    rest = written(_rest(members, components(stars), sets), "links")
    groups = components(stars.unionByName(rest))

    # smallest document of each component, then of each node
    grouped = written(nodes.join(groups, "key").select("node", "component", "rep"), "grouped")
    least = grouped.groupBy("component").agg(F.min("rep").alias("least"))
    named = grouped.join(least, "component").select("node", "least")
    named = nodes.join(named, "node", "left").select("node", F.coalesce("least", "rep").alias("component_id"))
    return counts.where("n is not null").join(named, "node", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _sets_of(docs: DataFrame, able: DataFrame, doc: str, text: str) -> DataFrame:
    """The whole sets of these nodes, from one document each."""
    ids = able.select("rep")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_NODES else ids
    texts = docs.select(F.col(doc).cast("long").alias("rep"), F.col(text).cast("string").alias("text")).join(few, "rep", "left_semi")
    sets = texts.select("text").mapInArrow(_whole_sets, "node binary, key long, n int, hashes binary")
    return sets.groupBy("node", "key", "n").agg(F.first("hashes").alias("hashes")).join(able, "node", "left_semi")


def _clusters(lists: DataFrame) -> DataFrame:
    """cluster (its leader's key), key, and how many lists of that leader the node has."""
    heads = lists.groupBy("shingle").agg(F.max(F.struct("share", (-F.col("key")).alias("least"))).alias("head"), F.count("*").alias("size"))
    heads = heads.where("size > 1").select("shingle", (-F.col("head.least")).alias("cluster"))
    return lists.join(heads, "shingle").groupBy("cluster", "key").agg(F.count("*").alias("lists"))


def _stars(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of each node with the two leaders it shares most lists with."""
    order = Window.partitionBy("key").orderBy(F.desc("lists"), "cluster")
    near = members.where("key <> cluster").withColumn("nth", F.row_number().over(order)).where("nth <= 2")
    index = near.select("cluster", "key", F.col("key").alias("component"))
    leaders = index.select("cluster").distinct().select("cluster", F.col("cluster").alias("key"), F.col("cluster").alias("component"))
    return _links(leaders, index, sets)


def _rest(members: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Links across components, in clusters that have several."""
    few = F.broadcast(groups) if groups.count() <= BROADCAST_NODES else groups
    named = members.join(few, "key", "left").select("cluster", "key", F.coalesce("component", "key").alias("component"))
    counts = named.groupBy("cluster", "component").count()
    largest = counts.groupBy("cluster").agg(F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("parts"))
    largest = largest.where("parts > 1").select("cluster", F.col("top.component").alias("main"))
    open_ones = written(named.join(largest, "cluster"), "open")
    index = open_ones.select("cluster", "key", "component")
    return _links(open_ones.where("component <> main").select("cluster", "key", "component"), index, sets)


def one_of_each(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that have the smallest id of their component, and all rows without an id.

    Rows equal in id and text stay once, the first by their other columns;
    different texts of one id all stay.
    """
    found = written(joined(docs, doc, text), "classes")
    kept = found.where(F.col("doc_id") == F.col("component_id"))
    ids = kept.groupBy(F.col("doc_id").alias(doc)).agg(F.count("*").alias("rows"))
    sizes = ids.agg(F.count("*").alias("ids"), F.max("rows").alias("most")).first()

    def rows_of(some: DataFrame) -> DataFrame:
        some = some.select(doc)
        return docs.join(F.broadcast(some) if sizes["ids"] <= BROADCAST_NODES else some, doc, "left_semi")

    nameless = docs.where(F.col(doc).isNull())
    if (sizes["most"] or 0) < 2:
        return rows_of(ids).unionByName(nameless)
    return rows_of(ids.where("rows = 1")).unionByName(_first_rows(rows_of(ids.where("rows > 1")), doc, text)).unionByName(nameless)


def _first_rows(rows: DataFrame, doc: str, text: str) -> DataFrame:
    """One row of each id and text, the least by its other columns."""
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != text]))
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    first = rows.groupBy(F.col(doc).alias("id"), F.sha2(F.encode(text, "UTF-8"), 256).alias("hash")).agg(F.min_by(whole, rest).alias("row"))
    return first.select("row.*")
