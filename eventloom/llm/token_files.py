"""Token ids of a corpus in binary files, in the order of the document ids.

The documents are dealt out by ranges of their ids, so file after file holds
them in ascending order. A task encodes its texts and writes one file of blocks.
Each block ranks its ids by how often they occur in it and stores the ranks in
one to four bytes with separate control bytes (``rank_code``), so frequent ids
take one byte. A block has its own rank table: it can be written in one pass,
read alone, and written again alone when an executor is lost. Files are written
under another name first and then moved, so a repeated task leaves one whole file.

Encoding keeps the ids of words it has met, also from file to file unless ``keep_words`` is
false: that holds less memory in idle workers and learns every file's words anew. Texts are cut at white space and
between an ASCII letter and an ASCII sign or digit, where this tokenizer's
words end too, and ASCII case is ignored as it is there; texts that hold the mark
of a special token are encoded as they are. Whether a tokenizer file allows all that is
tried on probe texts when it is loaded; with another one whole texts are encoded.

Block, all little-endian: the mark, then five 64-bit numbers (documents, ids, table
entries, control bytes, data bytes) and four (table's control and data bytes),
then document ids (64 bit), whether there is one (8 bit), ids per document
(64 bit), the table (ranked ids, coded the same way), control and data bytes.

Defined cases: a null or empty text holds the end id alone. Rows without an id
come first; rows with one id stand together in the order of a text hash. A very
long text makes its block longer. An empty table gives no file and no rows. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import rank_code
from eventloom.llm.common import KEPT_IN_WORKER, shared_folder, tasks_for, text_bytes, trim_memory, trimmed, written
from eventloom.llm.words import NOT_SPACE, buffer_of, ranges, row_blocks, words_of

END_ID = 2
#: Ids in a block, about.
BLOCK_IDS = 1 << 21
#: Text bytes in a file, about.
FILE_BYTES = 64 << 20
#: Words whose ids a worker keeps.
KEPT_WORDS = 1_000_000
#: Text bytes that are encoded at once; the arrays for them take about thirty times as much.
_CHUNK = 1 << 20
_MARK = b"FRQCODE1"

#: White space of ASCII, where every chunk ends.
_GAPS = NOT_SPACE.copy()
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = ~_LETTER & (np.arange(256) < 128) & NOT_SPACE

#: Texts in which case, white space, signs, digits or letters beyond ASCII may change the ids of a word.
_PROBES = [
    "The the THE tHe quick brown fox, Fox FOX jumps over",
    " leading  two\tand\nthree\r\n\n  trailing ",
    "don't I'LL we've x1y2 3.14 12,345 a-b_c (d) [e] f/g #h @i 100% $5 ...",
    "Été à l'œil ñandú straße ΣΊΣΥΦΟΣ İstanbul 漢字 かな 한국 🙂 “quoted”—dash…\u3000wide\u00a0space",
    "",
]


class WordIds:
    """Encodes texts with a tokenizer file and keeps the ids of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark uses the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()
        data, offsets = buffer_of(pa.array(_PROBES))
        ids, splits = self._by_words(data, offsets)
        self.by_words = [x.tolist() for x in np.split(ids, splits[1:-1])] == self.plain(_PROBES)
        self.forget()

    def forget(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        if len(self.hash) + len(hashes) > KEPT_WORDS:
            self.forget()
        found = self.plain(texts)
        size = np.array([len(x) for x in found], np.int32)
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(size.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used : self.used + len(flat)] = flat
        start = self.used + np.cumsum(size) - size
        self.used += len(flat)
        at = np.searchsorted(self.hash, hashes)
        self.hash, self.start, self.size = (np.insert(x, at, y) for x, y in ((self.hash, hashes), (self.start, start), (self.size, size)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the row splits."""
        return self._by_words(data, offsets) if self.by_words else self._whole(data, offsets)

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = self.plain([data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        splits = np.cumsum([0, *map(len, found)])
        return np.fromiter((i for x in found for i in x), np.uint32, int(splits[-1])), splits

    def _by_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(data, offsets, _GAPS, (_LETTER, _SIGN))
        unique, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
        known = np.zeros(len(unique), bool)
        if len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, unique), len(self.hash) - 1)
            known = self.hash[at] == unique
        if not known.all():
            if len(self.hash) + int((~known).sum()) > KEPT_WORDS:
                self.forget()
                known[:] = False
            new = np.flatnonzero(~known)
            self._learn(unique[new], [data[words.start[i] : words.end[i]].tobytes().decode() for i in first[new]])
        at = np.searchsorted(self.hash, unique)
        size = self.size[at][back].astype(np.int64)
        ids = self.pool[ranges(self.start[at][back].astype(np.int64), size)]
        splits = np.concatenate(([0], np.cumsum(size)))[words.splits]
        marked = [i for i in range(len(offsets) - 1) if b"<|" in data[offsets[i] : offsets[i + 1]].tobytes()] if b"<|" in data[offsets[0] : offsets[-1]].tobytes() else []
        if marked:
            rows = np.split(ids, splits[1:-1])
            for i, own in zip(marked, self.plain([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in marked]), strict=True):
                rows[i] = np.array(own, np.uint32)
            ids, splits = np.concatenate(rows), np.concatenate(([0], np.cumsum([len(x) for x in rows])))
        return ids, splits


_ENCODERS: dict[str, WordIds] = {}  # one per worker and tokenizer
KEPT_IN_WORKER.append(_ENCODERS.clear)


def _forget_words() -> None:
    for known in _ENCODERS.values():
        known.forget()


def encoder(path: str) -> WordIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def block_bytes(docs: list, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One block, as it stands in a file."""
    table, ranks = rank_code.ranked(ids.astype(np.int64))
    control, data = rank_code.encode(ranks)
    table_control, table_data = rank_code.encode(table)
    head = np.array([len(docs), len(ids), len(table), len(control), len(data), len(table_control), len(table_data)], "<u8")
    has = np.array([d is not None for d in docs], np.uint8)
    numbers = np.array([d if d is not None else 0 for d in docs], "<i8")
    parts = (numbers, has, np.asarray(lengths, "<u8"), table_control, table_data, control, data)
    return b"".join((_MARK, head.tobytes(), *(p.tobytes() for p in parts)))


def read_blocks(source):
    """Document ids (None where there is none), ids per document and all ids, block by block."""
    while mark := source.read(len(_MARK)):
        if bytes(mark) != _MARK:
            raise ValueError("not a block")
        docs, n, entries, c, d, tc, td = np.frombuffer(source.read(56), "<u8").tolist()
        take = lambda count, kind: np.frombuffer(source.read(count * np.dtype(kind).itemsize), kind)
        numbers, has, lengths = take(docs, "<i8"), take(docs, np.uint8), take(docs, "<u8").astype(np.int64)
        table_control, table_data, control, data = (take(k, np.uint8) for k in (tc, td, c, d))
        table = rank_code.decode(table_control, table_data, entries)
        yield [int(x) if h else None for x, h in zip(numbers, has, strict=True)], lengths, table[rank_code.decode(control, data, n)]


def _file(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def _write(folder: str, tokenizer: str, end_id: int):
    def of(batches):
        task = TaskContext.get()
        name = f"part-{task.partitionId():07d}.ids"
        system, base = _file(folder)
        system.create_dir(base, recursive=True)
        part = f"{base}/.{name}.{task.taskAttemptId()}"
        docs_in_all = ids_in_all = 0
        docs, pieces, lengths, held = [], [], [], 0
        with system.open_output_stream(part) as out:
            for batch in batches:
                data, offsets = buffer_of(batch.column(1))
                for a, b in row_blocks(offsets, _CHUNK):
                    ids, splits = encoder(tokenizer).encode(data, offsets[a : b + 1])
                    ends = splits[1:] + np.arange(b - a)
                    whole = np.full(len(ids) + b - a, end_id, np.uint32)
                    keep = np.ones(len(whole), bool)
                    keep[ends] = False
                    whole[keep] = ids
                    pieces.append(whole)
                    lengths.append(np.diff(splits) + 1)
                    docs += batch.column(0).slice(a, b - a).to_pylist()
                    held += len(whole)
                    if held >= BLOCK_IDS:
                        out.write(block_bytes(docs, np.concatenate(pieces), np.concatenate(lengths)))
                        docs_in_all, ids_in_all = docs_in_all + len(docs), ids_in_all + held
                        docs, pieces, lengths, held = [], [], [], 0
            if docs:
                out.write(block_bytes(docs, np.concatenate(pieces), np.concatenate(lengths)))
                docs_in_all, ids_in_all = docs_in_all + len(docs), ids_in_all + held
        if not docs_in_all:
            system.delete_file(part)
            return
        system.move(part, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "path": [f"{folder}/{name}"], "docs": [docs_in_all], "ids": [ids_in_all]}, schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    return of


def write_files(docs: DataFrame, tokenizer: str, folder: str, *, doc: str = "doc_id", text: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES, keep_words: bool = True) -> DataFrame:
    """Writes the files into a folder (URI) and returns part, path, docs, ids of each, in document order by part."""
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    n = tasks_for(docs.sparkSession, text_bytes(rows), file_bytes)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    of = trimmed(_write(folder, tokenizer, end_id), trim_memory, *([] if keep_words else [_forget_words]))
    return written(dealt.mapInArrow(of, "part int, path string, docs long, ids long"), "manifest")


def read_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in these files, read back."""
    spark, start, rows = files.sparkSession, 0, []
    for r in files.orderBy("part").select("path", "ids").toLocalIterator():  # one row per file
        rows.append((r["path"], start))
        start += r["ids"]
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def of(batches):
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, path = _file(uri)
                with system.open_input_stream(path) as source:
                    for docs, lengths, ids in read_blocks(source):
                        ends = np.cumsum(lengths)
                        raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                        crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(base + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        base += int(ends[-1])

    places = spark.createDataFrame(rows, "path string, base long").repartition(len(rows), "path")
    return places.mapInArrow(trimmed(of), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """Writes the corpus as token files into the shared folder and returns what they hold."""
    return read_files(write_files(docs, tokenizer, shared_folder(docs.sparkSession, "token-files"), **how))
