"""A Merkle manifest of a table: a tree of hashes per group of rows, and a tree over the groups.

A row's leaf is the hash of its columns. In its group (a language, say) leaves
ascend by row id, and every run of ``FANOUT`` neighbours becomes one node until one
is left, the group's subroot; the subroots in order of their groups do likewise up to the
root. A row is proved by its siblings on the way up.

No group is ever sorted. Its row ids go into compressed bitmaps, one per 32,768
neighbouring numbers: the tasks' bitmaps are merged, rows before each block of 512
numbers are kept beside the bits (a popcount directory), and the rows before each bitmap are
running sums over a radix tree of bitmap numbers. A rank query, popcounts up to the row's bit, gives
the row's slot in its group. From then on slots are keys: a task takes one array of
``CHUNK`` slots, four levels of the tree, puts each hash into its place, and leaves one node.
So a level set of four costs one shuffle of hashes, and texts never move.

The driver reads counts, the root, and nothing that grows with the rows.

Defined cases: a null column stands as ``-`` in the leaf, apart from an empty one. Rows without an
id come first in their group; rows of one id are ordered by their leaves, and rows equal in all
hashed columns are interchangeable and each get a slot. Rows without a group are a group,
before all others. Very long texts only lengthen the hashing of their row. A group of one row has its
leaf as subroot, one group its subroot as root; an empty table gives no rows. Other columns are
not looked at, so they may have any name. Row ids are whole numbers of up to 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from eventloom.llm.common import written
from eventloom.operators.joins import hot_key_join
from eventloom.sources.scratch import scratch_path

FANOUT = 8
#: Levels that one task goes up at a time, and the slots below them.
LEVELS = 4
CHUNK_BITS = 3 * LEVELS
CHUNK = 1 << CHUNK_BITS
#: Row ids of a bitmap, and of a block of its directory.
SPAN_BITS, BLOCK_BITS = 15, 9
SPAN = 1 << SPAN_BITS
#: A bitmap of fewer ids is kept as their list.
SPARSE = 2048
#: Bitmap numbers whose running sum is one window.
DIGIT_BITS = 12
#: Decoded bytes of bitmaps that may be broadcast.
BROADCAST_BYTES = 32 << 20
#: Equal rows that are given their slots at once.
COPIES = 1 << 16
#: The bitmap of rows without an id, below all others.
NO_ID = -(1 << 48) - 1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(column: str | Column) -> Column:
    """A value as it stands in a leaf: UTF-8 bytes, colon, value; or ``-``."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the encoded columns, as bytes."""
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in columns]), 256))


def _group_key(group: str) -> Column:
    """A key that is never null; the missing group sorts before all others, bytewise."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))


# ---- bitmaps ------------------------------------------------------------------


def _containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: a batch's ids as positions with counts, one row per group and bitmap."""
    for batch in batches:
        group = batch.column("grp").dictionary_encode()
        keys = np.stack([group.indices.to_numpy(), batch.column("span").to_numpy(), batch.column("pos").to_numpy()])
        found, counts = np.unique(keys, axis=1, return_counts=True)
        if not found.shape[1]:
            continue
        starts = np.flatnonzero(np.append(True, (found[:2, 1:] != found[:2, :-1]).any(axis=0)))
        offsets = np.append(starts, found.shape[1]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                group.dictionary.take(pa.array(found[0, starts])),
                pa.array(found[1, starts]),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(found[2].astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts)),
            ],
            names=["grp", "span", "positions", "counts"],
        )


_BITMAP = (
    "grp string, span long, n long, bits binary, before array<long>, "
    "repeats array<array<struct<pos:int,n:long>>>, positions array<int>, starts array<long>"
)


def _merged(part: pa.Table) -> pa.Table:
    """For applyInArrow: one group's bitmap of ``SPAN`` ids, with its directory.

    Few ids are kept as a list with the rows before each; many as bits with the rows
    before each block, and per block the ids that occur more than once.
    """
    counts = np.zeros(SPAN, np.int64)
    for positions, many in zip(part.column("positions").chunks, part.column("counts").chunks, strict=True):
        np.add.at(counts, positions.flatten().to_numpy(), many.flatten().to_numpy())
    held = np.flatnonzero(counts)
    row = {"grp": part.column("grp")[0].as_py(), "span": part.column("span")[0].as_py(), "n": int(counts.sum())}
    row |= dict.fromkeys(("bits", "before", "repeats", "positions", "starts"))
    if len(held) < SPARSE:
        row["positions"], row["starts"] = held.tolist(), np.append(0, np.cumsum(counts[held])).tolist()
    else:
        blocks = counts.reshape(-1, 1 << BLOCK_BITS)
        row["bits"] = np.packbits(counts > 0, bitorder="little").tobytes()
        row["before"] = (np.cumsum(blocks.sum(axis=1)) - blocks.sum(axis=1)).tolist()
        if (counts > 1).any():
            first = np.arange(0, SPAN, 1 << BLOCK_BITS)
            row["repeats"] = [
                [{"pos": int(f + p), "n": int(b[p])} for p in np.flatnonzero(b > 1)] for f, b in zip(first, blocks, strict=True)
            ]
    kinds = pa.schema(
        [
            ("grp", pa.string()),
            ("span", pa.int64()),
            ("n", pa.int64()),
            ("bits", pa.binary()),
            ("before", pa.list_(pa.int64())),
            ("repeats", pa.list_(pa.list_(pa.struct([("pos", pa.int32()), ("n", pa.int64())])))),
            ("positions", pa.list_(pa.int32())),
            ("starts", pa.list_(pa.int64())),
        ]
    )
    return pa.Table.from_pylist([row], schema=kinds)


def _before(sums: DataFrame, width: int) -> DataFrame:
    """Rows of a group in smaller bitmap numbers ``span``, of which there may be ``width``.

    A digit of the number is one window of at most 4,096 rows; a longer number first
    sums up its higher digits in the same way.
    """
    earlier = lambda keys: Window.partitionBy(*keys).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(earlier(["grp"] if width <= 1 << DIGIT_BITS else ["grp", "upper"])), F.lit(0))
    if width <= 1 << DIGIT_BITS:
        return sums.select("grp", "span", inside.alias("base"))
    sums = sums.withColumn("upper", F.shiftright("span", DIGIT_BITS))
    upper = sums.groupBy("grp", F.col("upper").alias("span")).agg(F.sum("n").alias("n"))
    upper = _before(upper, (width >> DIGIT_BITS) + 2).toDF("grp", "upper", "upper_base")
    inside = sums.select("grp", "span", "upper", inside.alias("inside"))
    return inside.join(upper, ["grp", "upper"]).select("grp", "span", (F.col("upper_base") + F.col("inside")).alias("base"))


@dataclass
class Ranks:
    """Per group and bitmap: bits, directory, rows before it, rows of the group."""

    bitmaps: DataFrame
    groups: DataFrame
    decoded_bytes: int
    largest: int


def ranks(ids: DataFrame) -> Ranks | None:
    """Bitmaps of ids (grp, span, pos) with a rank directory; None without rows."""
    found = written(
        ids.mapInArrow(_containers, "grp string, span long, positions array<int>, counts array<long>")
        .groupBy("grp", "span")
        .applyInArrow(_merged, _BITMAP),
        "manifest-bitmaps",
    )
    some = F.col("span") != NO_ID
    cells = F.coalesce(F.octet_length("bits"), F.lit(0)) + 8 * F.greatest(F.size("before"), F.lit(0))
    cells += 12 * F.greatest(F.size("positions"), F.lit(0)) + 200
    cells += F.coalesce(F.aggregate("repeats", F.lit(0).cast("long"), lambda s, r: s + 24 * F.size(r)), F.lit(0).cast("long"))
    facts = found.agg(F.count(F.lit(1)), F.min(F.when(some, F.col("span"))), F.max(F.when(some, F.col("span"))), F.sum(cells)).first()
    if not facts[0]:
        return None
    low, high = (0, 0) if facts[1] is None else facts[1:3]
    # rows without an id stand one bitmap before the first
    placed = found.select("grp", F.greatest("span", F.lit(low - 1)).alias("span"), "n")
    base = _before(placed, high - low + 2).withColumn("span", F.when(F.col("span") < low, F.lit(NO_ID)).otherwise(F.col("span")))
    groups = found.groupBy("grp").agg(F.sum("n").alias("rows_of_group"))
    bitmaps = written(found.drop("n").join(base, ["grp", "span"]).join(groups, "grp"), "manifest-ranks")
    largest = groups.agg(F.max("rows_of_group")).first()[0]
    return Ranks(bitmaps, bitmaps.select("grp", "rows_of_group").distinct(), int(facts[3]), largest)


def _slot() -> tuple[Column, Column]:
    """A row's slot by popcounts before its bit, and the rows that share its id."""
    pos, block = F.col("pos"), F.shiftright("pos", BLOCK_BITS)
    byte, first = F.shiftright("pos", 3), F.shiftleft(block, BLOCK_BITS - 3)
    whole = F.bitmap_count(F.substring("bits", first + 1, byte - first))
    last = F.conv(F.hex(F.substring("bits", byte + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), pos.bitwiseAND(F.lit(7))) - 1
    dense = F.get("before", block) + whole + F.bit_count(last.bitwiseAND(mask))
    again = F.get("repeats", block)
    more = F.aggregate(again, F.lit(0).cast("long"), lambda s, r: s + F.when(r["pos"] < pos, r["n"] - 1).otherwise(F.lit(0)))
    same = F.get(F.filter(again, lambda r: r["pos"] == pos), F.lit(0))["n"]
    place = (F.array_position("positions", pos) - 1).cast("int")
    sparse = F.get("starts", place)
    is_dense = F.col("bits").isNotNull()
    slot = F.when(is_dense, dense + F.coalesce(more, F.lit(0))).otherwise(sparse)
    many = F.when(is_dense, F.coalesce(same, F.lit(1))).otherwise(F.get("starts", place + 1) - sparse)
    return F.col("base") + slot, many


def _spread_copies(rows: DataFrame) -> DataFrame:
    """Slots of rows that share their id: by leaf, in lanes of its first bytes; equal rows
    are counted, not moved, and come back as often as they were there."""
    same = rows.groupBy("doc_id", "grp", "leaf", "changed", "slot", "rows_of_group").agg(F.count(F.lit(1)).alias("copies"))
    same = same.withColumn("lane", F.substring(F.hex("leaf"), 1, 4))
    an_id = ["grp", "slot"]
    before = lambda keys, order: Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    lanes = same.groupBy(*an_id, "lane").agg(F.sum("copies").alias("copies"))
    lanes = lanes.select(*an_id, "lane", F.coalesce(F.sum("copies").over(before(an_id, "lane")), F.lit(0)).alias("lane_base"))
    inside = F.coalesce(F.sum("copies").over(before([*an_id, "lane"], "leaf")), F.lit(0))
    placed = same.withColumn("inside", inside).join(lanes, [*an_id, "lane"])
    placed = placed.withColumn("first", F.col("slot") + F.col("lane_base") + F.col("inside"))
    last = F.col("copies") - 1
    pieces = placed.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", last, F.lit(COPIES)))))
    pieces = pieces.repartition("grp", "first", "piece")
    start = F.col("piece") * COPIES
    copy = F.explode(F.sequence(start, F.least(last, start + (COPIES - 1))))
    return pieces.withColumn("copy", copy).withColumn("slot", F.col("first") + F.col("copy")).select(*[c for c in rows.columns])


def slotted(leaves: DataFrame) -> tuple[DataFrame, Ranks] | None:
    """Rows (doc_id, grp, leaf, changed) with their slot and the rows of their group."""
    spans = leaves.withColumns(
        {
            "span": F.coalesce(F.shiftright("doc_id", SPAN_BITS), F.lit(NO_ID)),
            "pos": F.coalesce(F.col("doc_id").bitwiseAND(F.lit(SPAN - 1)).cast("int"), F.lit(0)),
        }
    )
    index = ranks(spans.select("grp", "span", "pos"))
    if index is None:
        return None
    if index.decoded_bytes <= BROADCAST_BYTES:
        found = spans.join(F.broadcast(index.bitmaps), ["grp", "span"])
    else:
        found = hot_key_join(spans, index.bitmaps, ["grp", "span"], spread_by=["leaf"], max_bytes=0)
    slot, many = _slot()
    names = ["doc_id", "grp", "leaf", "changed", "slot", "rows_of_group"]
    found = found.select("doc_id", "grp", "leaf", "changed", slot.alias("slot"), many.alias("many"), "rows_of_group")
    path, seen = scratch_path(leaves.sparkSession, "manifest-slots"), Observation()
    found.observe(seen, F.count_if(F.col("many") > 1).alias("shared")).write.parquet(path)
    rows = leaves.sparkSession.read.schema(found.schema).parquet(path)
    if not seen.get["shared"]:
        return rows.select(*names), index
    alone, shared = rows.where("many = 1").select(*names), rows.where("many > 1").select(*names)
    return written(alone.unionByName(_spread_copies(shared)), "manifest-copies"), index


# ---- the tree -----------------------------------------------------------------


def height(n: int) -> int:
    """Levels above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _level_arrays(nodes: pa.Table) -> list[list[str]]:
    """The slot array of a chunk and the levels above it, in hex."""
    place = nodes.column("idx").to_numpy() & (CHUNK - 1)
    array: list[str] = [""] * len(place)
    for at, value in zip(place.tolist(), nodes.column("hash").to_pylist(), strict=True):
        array[at] = value.hex()
    levels = [array]
    for _ in range(min(LEVELS, height(nodes.column("n")[0].as_py()))):
        below = levels[-1]
        levels.append([_hash("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def _sides(level: list[str]) -> list[tuple[str, str]]:
    """Per node of a level its siblings to the left and to the right."""
    out = []
    for i in range(0, len(level), FANOUT):
        run = level[i : i + FANOUT]
        out += [("".join(run[:j]), "".join(run[j + 1 :])) for j in range(len(run))]
    return out


_NODES = "grp string, idx long, hash binary, n long"


def _raised(nodes: pa.Table) -> pa.Table:
    """For applyInArrow: one chunk of slots becomes one node, ``LEVELS`` levels up or at the top."""
    levels = _level_arrays(nodes)
    n = nodes.column("n")[0].as_py()
    for _ in levels[1:]:
        n = -(-n // FANOUT)
    index = nodes.column("idx")[0].as_py() >> CHUNK_BITS
    return pa.table(
        {
            "grp": nodes.column("grp")[:1],
            "idx": pa.array([index], pa.int64()),
            "hash": pa.array([bytes.fromhex(levels[-1][0])]),
            "n": pa.array([n], pa.int64()),
        }
    )


_PATHS = "grp string, idx long, subroot string, left array<string>, right array<string>"


def _way_up(levels: list[list[str]], place: int, sides: list[list[tuple[str, str]]]) -> list[tuple[str, str]]:
    return [sides[k][place >> 3 * k] for k in range(len(levels) - 1)]


def _lowered(nodes: pa.Table, path: pa.Table) -> pa.Table:
    """For a cogrouped applyInArrow: the siblings on the way up of each node of a chunk,
    from those of the chunk's node."""
    levels = _level_arrays(nodes)
    sides = [_sides(level) for level in levels[:-1]]
    above = path.to_pylist()[0]
    ways = [_way_up(levels, i & (CHUNK - 1), sides) for i in nodes.column("idx").to_pylist()]
    return pa.table(
        {
            "grp": nodes.column("grp"),
            "idx": nodes.column("idx"),
            "subroot": pa.array([above["subroot"]] * len(nodes), pa.string()),
            "left": pa.array([[a for a, _ in w] + above["left"] for w in ways], pa.list_(pa.string())),
            "right": pa.array([[b for _, b in w] + above["right"] for w in ways], pa.list_(pa.string())),
        }
    )


_PROOFS = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def _proved(nodes: pa.Table, path: pa.Table) -> pa.Table:
    """For a cogrouped applyInArrow: proof and folded root of each leaf of a chunk."""
    levels = _level_arrays(nodes)
    sides = [_sides(level) for level in levels[:-1]]
    above = path.to_pylist()[0]
    rest = list(zip(above["left"], above["right"], strict=True))
    rest_text = "".join(a + b for a, b in rest)
    proofs, folded, leaves = [], [], []
    for index, original, changed in zip(
        nodes.column("idx").to_pylist(), nodes.column("hash").to_pylist(), nodes.column("changed").to_pylist(), strict=True
    ):
        way = _way_up(levels, index & (CHUNK - 1), sides)
        proofs.append(_hash("".join(a + b for a, b in way) + rest_text))
        node = (changed or original).hex()
        for a, b in way + rest:
            node = _hash(a + node + b)
        folded.append(node)
        leaves.append(original.hex())
    return pa.table(
        {
            "doc_id": nodes.column("doc_id"),
            "leaf": pa.array(leaves, pa.string()),
            "subroot": pa.array([above["subroot"]] * len(nodes), pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
        }
    )


def _raise_all(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The nodes and those of every ``LEVELS`` levels above them, up to one per group."""
    tables = [nodes]
    for _ in range(-(-height(largest) // LEVELS)):
        up = tables[-1].groupBy("grp", F.shiftright("idx", CHUNK_BITS).alias("chunk")).applyInArrow(_raised, _NODES)
        tables.append(written(up, "manifest-nodes"))
    return tables


def _cogrouped(nodes: DataFrame, paths: DataFrame, of, kinds: str) -> DataFrame:
    """Chunks of slots, each with the path of the node it becomes."""
    chunks = nodes.groupBy("grp", F.shiftright("idx", CHUNK_BITS).alias("chunk"))
    return chunks.cogroup(paths.groupBy("grp", F.col("idx").alias("chunk"))).applyInArrow(of, kinds)


def _lower_all(tables: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the second lowest table's nodes, from those of the top ones."""
    for nodes in reversed(tables[1:-1]):
        paths = written(_cogrouped(nodes, paths, _lowered, _PATHS), "manifest-paths")
    return paths


@dataclass
class Manifest:
    """The written trees of a table: the rows with their slots, the nodes of the levels
    that were written, the subroots' paths to the root, and the root."""

    rows: DataFrame
    levels: list[DataFrame]
    paths: DataFrame
    root: str


def _numbered(groups: DataFrame) -> DataFrame:
    """The groups' places in bytewise order; lanes of their first bytes are at most 65,537."""
    lanes = groups.withColumn("lane", F.hex(F.substring(F.encode("grp", "UTF-8"), 1, 3)))
    sizes = lanes.groupBy("lane").agg(F.count(F.lit(1)).alias("groups"))
    upto = Window.partitionBy(F.lit(0)).orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("lane", F.coalesce(F.sum("groups").over(upto), F.lit(0)).alias("lane_base"))
    inside = F.row_number().over(Window.partitionBy("lane").orderBy("grp")) - 1
    return lanes.withColumn("inside", inside).join(sizes, "lane").select("grp", (F.col("lane_base") + F.col("inside")).alias("place"))


def manifest(
    table: DataFrame, *, columns: Sequence[str] = COLUMNS, group: str = "lang", row_id: str = "doc_id", changed: Column | None = None
) -> Manifest | None:
    """Builds the trees of a table; None of an empty one.

    ``changed`` is a leaf as it is found later, null where a row has not changed.
    """
    if dict(table.dtypes)[row_id] not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{row_id} must be a whole number")
    changed = F.lit(None).cast("binary") if changed is None else changed
    leaves = table.select(
        F.col(row_id).cast("long").alias("doc_id"), _group_key(group).alias("grp"), leaf(columns).alias("leaf"), changed.alias("changed")
    )
    found = slotted(written(leaves, "manifest-leaves"))
    if found is None:
        return None
    rows, index = found
    nodes = rows.select("grp", F.col("slot").alias("idx"), F.col("leaf").alias("hash"), F.col("rows_of_group").alias("n"))
    levels = _raise_all(nodes, index.largest)
    subroots, count = levels[-1], index.groups.count()
    places = subroots.select("grp", "hash").join(_numbered(index.groups), "grp")
    places = written(places, "manifest-subroots")
    first = places.select(F.lit("").alias("grp"), F.col("place").alias("idx"), "hash", F.lit(count).cast("long").alias("n"))
    top = _raise_all(first, count)
    root = top[-1].select(F.lower(F.hex("hash"))).first()[0]
    start = top[0].sparkSession.createDataFrame([("", 0, "", [], [])], _PATHS)
    ways = start if len(top) == 1 else _cogrouped(top[0], _lower_all(top, start), _lowered, _PATHS)
    paths = places.join(ways.drop("grp", "subroot"), F.col("place") == F.col("idx")).select(
        "grp", F.lit(0).cast("long").alias("idx"), F.lower(F.hex("hash")).alias("subroot"), "left", "right"
    )
    return Manifest(rows, levels, written(paths, "manifest-paths"), root)


def proofs(found: Manifest) -> DataFrame:
    """Per row its leaf, its subroot, the digest of its siblings, and the root that its
    leaf, or the changed one, folds up to with them."""
    nodes = found.rows.select(
        "doc_id", "grp", F.col("slot").alias("idx"), F.col("leaf").alias("hash"), "changed", F.col("rows_of_group").alias("n")
    )
    return _cogrouped(nodes, _lower_all(found.levels, found.paths), _proved, _PROOFS)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns; a third of the rows is tampered with: its text's A-Z become a-z."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", upper, upper.lower())
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(tampered, leaf(["doc_id", "source", "lang", "n_chars", lowered]))
    found = manifest(docs, changed=changed)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )
    root = F.lit(found.root)
    return proofs(found).select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )
