"""Benchmark decontamination with an index of each training shard.

Every task cuts its documents into shards of about ``SHARD_WORDS`` words and
builds an FM-index of each: suffix order, wavelet ranks over the preceding
words, sampled suffix positions. All test phrases are searched backwards at
once; their occurrences are located and merged into spans of words to remove.
No document leaves its task: the job has no shuffle.

Words are runs of digits, letters and non-ASCII characters, with A-Z in lower
case. They are compared by 64-bit hashes. A phrase is ten consecutive words of
a test item; an item of fewer words, but not none, is one phrase.

The phrases are broadcast in blocks of at most ``BLOCK_BYTES`` of item text. A
larger test set is searched block by block, with the spans found so far written
between them.

Defined cases: a null or empty text has no words and no hits. A null item text
gives no phrase; an item without an id marks words but is not counted. Repeated
items count once by id. Repeated documents each keep their row. A text longer
than a shard is a shard of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import trimmed, written
from eventloom.llm.fm_index import FMIndex
from eventloom.llm.words import LETTERS_AND_DIGITS, buffer_of, ranges, row_blocks, words_of

PHRASE_WORDS = 10
SHARD_WORDS = 1 << 19
SHARD_BYTES = SHARD_WORDS * 6
BLOCK_BYTES = 16 << 20

_FOUND = "spans binary, items array<string>, n_words long, n_hit long"


class Phrases:
    """Distinct phrases of a block of items, as symbols, and the items of each."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        words = words_of(*buffer_of(pa.array([t for _, t in items], pa.string())), LETTERS_AND_DIGITS)
        self.vocabulary = np.unique(words.hash)
        symbol = np.searchsorted(self.vocabulary, words.hash) + 1
        n = np.diff(words.splits)
        count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        start = ranges(words.splits[:-1], count)
        item = np.repeat(np.arange(len(items)), count)
        length = np.minimum(n[item], size)
        grid = start[:, None] + np.arange(size)
        filled = np.arange(size) < length[:, None]
        rows = np.where(filled, symbol[np.minimum(grid, len(symbol) - 1)], 0) if len(start) else np.zeros((0, size), np.int64)
        self.phrase, back = np.unique(rows, axis=0, return_inverse=True)
        self.length = (self.phrase > 0).sum(1)
        pairs = np.unique(np.stack((back.reshape(-1), item)), axis=1)
        self.item_of = pairs[1]
        self.item_from = np.searchsorted(pairs[0], np.arange(len(self.phrase) + 1))
        self.names = [name for name, _ in items]


def _n_blocks(benchmark: DataFrame, text: str, limit: int) -> int:
    return -(-(benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0) // limit)


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int):
    """The test items in blocks of at most about ``limit`` bytes of text, one at a time."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where(F.octet_length("text") > 0)
    n = _n_blocks(benchmark, text, limit)
    if not n:
        yield []
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield [(r["item"], r["text"]) for r in part.collect()]


def _runs(inside: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte spans of the runs of words that are inside."""
    if not inside.any():
        return np.zeros((0, 2), np.int64)
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    return np.stack((start[np.flatnonzero(edge == 1)], end[np.flatnonzero(edge == -1) - 1]), 1)


def find_in_shard(data: np.ndarray, offsets: np.ndarray, phrases: Phrases):
    """Per text: byte spans of words inside phrases, items found, words, words hit."""
    words = words_of(data, offsets, LETTERS_AND_DIGITS)
    rows, n = len(offsets) - 1, len(words.hash)
    hit = np.zeros(n + 1, np.int64)
    doc, found_items = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(phrases.vocabulary) and n:
        at = np.searchsorted(phrases.vocabulary, words.hash)
        known = phrases.vocabulary[np.minimum(at, len(phrases.vocabulary) - 1)] == words.hash
        symbol = np.where(known, at + 1, 0)
        # one break for each run of unknown words, and one before each text
        keep = known | np.concatenate(([True], known[:-1]))
        first = np.zeros(n + 1, bool)
        first[words.splits[:-1]] = True
        lead = first[:-1] & known
        extra = np.cumsum(lead & keep)
        place = np.cumsum(keep) - 1 + extra
        sequence = np.zeros(int(place[-1]) + 1, np.int64)
        word_at = np.full(len(sequence), -1, np.int64)
        sequence[place[keep]] = symbol[keep]
        word_at[place[keep]] = np.flatnonzero(keep)
        index = FMIndex(sequence, len(phrases.vocabulary))
        low, high = index.search(phrases.phrase, phrases.length)
        which = np.flatnonzero(high > low)
        count = (high - low)[which]
        start = word_at[index.locate(ranges(low[which], count))]
        phrase = np.repeat(which, count)
        np.add.at(hit, start, 1)
        np.add.at(hit, start + phrases.length[phrase], -1)
        row = np.searchsorted(words.splits, start, "right") - 1
        own = phrases.item_from[phrase + 1] - phrases.item_from[phrase]
        pairs = np.unique(np.stack((np.repeat(row, own), phrases.item_of[ranges(phrases.item_from[phrase], own)])), axis=1)
        doc, found_items = pairs[0], pairs[1]
    inside = np.cumsum(hit[:-1]) > 0
    item_splits = np.searchsorted(doc, np.arange(rows + 1))
    for i in range(rows):
        a, b = words.splits[i], words.splits[i + 1]
        own = inside[a:b]
        spans = _runs(own, words.start[a:b], words.end[a:b]) - offsets[i]
        names = {phrases.names[k] for k in found_items[item_splits[i] : item_splits[i + 1]]}
        yield spans, sorted(x for x in names if x is not None), int(b - a), int(own.sum())


def _search(phrases, text: str, schema: pa.Schema, again: bool):
    """Function for mapInArrow: adds what this block of phrases finds to every row."""

    def of(batches):
        for batch in batches:
            data, offsets = buffer_of(batch.column(text))
            for a, b in row_blocks(offsets, SHARD_BYTES):
                part = batch.slice(a, b - a)
                found = list(find_in_shard(data, offsets[a : b + 1], phrases.value))
                spans, items, n_words, n_hit = ([x[k] for x in found] for k in range(4))
                if again:
                    old = [np.frombuffer(x, "<i8").reshape(-1, 2) for x in part.column("spans").to_pylist()]
                    items = [sorted({*x, *y}) for x, y in zip(items, part.column("items").to_pylist(), strict=True)]
                    both = [_merged(data, offsets[a + i : a + i + 2], x, y) for i, (x, y) in enumerate(zip(spans, old, strict=True))]
                    spans, n_hit = ([x[k] for x in both] for k in range(2))
                columns = [part.column(n) for n in part.schema.names if n not in ("spans", "items", "n_words", "n_hit")]
                columns += [pa.array([x.astype("<i8").tobytes() for x in spans], pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return of


def _merged(data: np.ndarray, offsets: np.ndarray, *spans: np.ndarray) -> tuple[np.ndarray, int]:
    """Spans of one text in one list, as one search would give them, and the words inside."""
    if not any(map(len, spans)):
        return spans[0], 0
    words = words_of(data, offsets, LETTERS_AND_DIGITS)
    inside = np.zeros(len(words.start), bool)
    for some in spans:
        if len(some):
            at = np.searchsorted(some[:, 0], words.start - offsets[0], "right") - 1
            inside |= (at >= 0) & (words.start - offsets[0] < some[np.maximum(at, 0), 1])
    return _runs(inside, words.start, words.end) - offsets[0], int(inside.sum())


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id",
    item_text: str = "text", size: int = PHRASE_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each document row with ``spans`` (pairs of byte offsets, little-endian 64 bit,
    past-the-end second), ``items``, ``n_words`` and ``n_hit``. Columns of these
    names in ``docs`` must be renamed before."""
    from pyspark.sql.pandas.types import to_arrow_schema

    clash = {"spans", "items", "n_words", "n_hit"} & set(docs.columns)
    if clash:
        raise ValueError(f"rename these columns first: {sorted(clash)}")
    context, out, again = docs.sparkSession.sparkContext, docs, False
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", " + _FOUND
    schema = docs.sparkSession.createDataFrame([], kinds).schema
    for items in _blocks(benchmark, item, item_text, block_bytes):
        if again:
            out = written(out, "spans")
            phrases.destroy()  # no task asks for the last block again
        phrases = context.broadcast(Phrases(items, size))
        out = out.mapInArrow(trimmed(_search(phrases, text, to_arrow_schema(schema), again)), schema)
        again = True
    return out


def digest(found: DataFrame, doc: str = "doc_id") -> DataFrame:
    """What the search found, one row per document."""
    names = F.array_join("items", ",")
    return found.select(
        F.col(doc).alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(names, "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut(text: bytes, spans: np.ndarray) -> bytes:
    edges = np.concatenate(([0], spans.reshape(-1), [len(text)]))
    return b"".join(text[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))


def without_passages(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", chars: str = "n_chars", item: str = "item_id",
    item_text: str = "text", size: int = PHRASE_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with every span cut out of the text, until no phrase is left.

    Cutting may bring words together that form a phrase again; such texts are
    searched once more, by all blocks. Spans of all blocks are merged before a
    cut, so the result does not depend on ``block_bytes``. ``chars``, if there,
    follows the new text. Clean rows stay as they are.
    """
    out = docs
    if _n_blocks(benchmark, item_text, block_bytes) > 1:
        out = _cut_in_rounds(docs, benchmark, text=text, item=item, item_text=item_text, size=size, block_bytes=block_bytes)
    else:
        for items in _blocks(benchmark, item, item_text, block_bytes):
            phrases = docs.sparkSession.sparkContext.broadcast(Phrases(items, size))
            out = docs.mapInArrow(trimmed(_remove(phrases, text)), docs.schema)
    if chars in docs.columns:
        out = out.withColumn(chars, F.length(text).cast(docs.schema[chars].dataType))
    return out


def _cut_in_rounds(docs: DataFrame, benchmark: DataFrame, *, text: str, **how) -> DataFrame:
    """Search the texts by all blocks and cut the merged spans; then again those that were cut."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = [f"c{i}" for i in range(len(docs.columns))]  # none that contamination() adds
    held, text = docs.toDF(*names), names[docs.columns.index(text)]
    done, schema = None, held.schema
    while True:
        found = written(contamination(held, benchmark, text=text, **how), "found")
        clean = found.where("n_hit = 0").select(names)
        done = clean if done is None else done.union(clean)
        hit = found.where("n_hit > 0")
        if hit.isEmpty():
            return done.toDF(*docs.columns)
        held = written(hit.mapInArrow(_cut_found(text, to_arrow_schema(schema)), schema), "cut")


def _cut_found(text: str, schema: pa.Schema):
    """Function for mapInArrow: the rows without the columns of the search, their spans cut out."""

    def of(batches):
        for batch in batches:
            spans = (np.frombuffer(x, "<i8").reshape(-1, 2) for x in batch.column("spans").to_pylist())
            values = [_cut(t.encode(), s).decode() for t, s in zip(batch.column(text).to_pylist(), spans, strict=True)]
            columns = [pa.array(values, f.type) if f.name == text else batch.column(f.name).cast(f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return of


def _remove(phrases, text: str):
    def of(batches):
        for batch in batches:
            k = batch.schema.get_field_index(text)
            data, offsets = buffer_of(batch.column(text))
            for a, b in row_blocks(offsets, SHARD_BYTES):
                part, new = batch.slice(a, b - a), {}
                for i, (spans, *_) in enumerate(find_in_shard(data, offsets[a : b + 1], phrases.value)):
                    if len(spans):
                        new[i] = _clean(_cut(data[offsets[a + i] : offsets[a + i + 1]].tobytes(), spans), phrases.value)
                if new:
                    values = part.column(k).to_pylist()
                    for i, value in new.items():
                        values[i] = value.decode()
                    part = part.set_column(k, batch.schema.field(k), pa.array(values, batch.schema.field(k).type))
                yield part

    return of


def _clean(value: bytes, phrases: Phrases) -> bytes:
    while True:
        data = np.frombuffer(value, np.uint8)
        spans = next(find_in_shard(data, np.array([0, len(data)]), phrases))[0]
        if not len(spans):
            return value
        value = _cut(value, spans)


def brute(texts: list, items: list[tuple], size: int = PHRASE_WORDS) -> list[tuple]:
    """The same counts by plain loops, for tests: (n_words, n_hit, n_items, sha256)."""
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    phrases = [(i, tuple(w[k : k + size])) for i, t in items for w in [split(t)] for k in range(max(1, len(w) - size + 1)) if w]
    out = []
    for t in texts:
        w, hit, names = split(t), set(), set()
        for i, p in phrases:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    names.add(str(i))
        out.append((len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()))
    return out
