"""Words and shingles of whole texts as numpy arrays, used inside tasks.

A text column arrives from Arrow as one byte buffer with offsets. Words are
found and hashed on the bytes, in pieces of bounded size that are cut between
words, so that no Python object is made for a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into 64-bit hashes at once.
PIECE = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of a word: digits, letters and everything beyond ASCII.
LETTERS_AND_DIGITS = np.ones(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    LETTERS_AND_DIGITS[_low : _high + 1] = False

#: Bytes of a word: all but blank, tab, line feed, vertical tab, form feed, return.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

_random = np.random.default_rng(20240607)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, PIECE), _powers(_BASE_INVERSE, PIECE)


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= PIECE:
        return _UP, _DOWN
    return _powers(_BASE, n), _powers(_BASE_INVERSE, n)


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


@dataclass
class Words:
    """hash, start and end byte of each word; row i has words splits[i]:splits[i+1]."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    splits: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.splits) - 1), np.diff(self.splits))


def words_of(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, cut: tuple[np.ndarray, np.ndarray] | None = None) -> Words:
    """All words of the rows; ``member`` tells which bytes belong to words.

    ``cut``: between a byte of the first kind and one of the second a word ends too.
    """
    member = member[_LOWER]
    first, last = int(offsets[0]), int(offsets[-1])
    at_row = np.zeros(last - first + 1, bool)
    at_row[offsets - first] = True
    hashes, starts, ends = [], [], []
    at = first
    while at < last:
        to = min(last, at + PIECE)
        while to < last:  # cut before a row or after a byte that is in no word
            near = max(at, to - 4096)
            cuts = np.flatnonzero(~member[data[near:to]] | at_row[near - first + 1 : to - first + 1])
            if len(cuts):
                to = near + int(cuts[-1]) + 1
                break
            to = min(last, to + PIECE)  # a very long word
        piece = _LOWER[data[at:to]]
        inside = member[data[at:to]]
        fresh = at_row[at - first : to - first].copy()
        fresh[0] = True
        if cut is not None:
            fresh[1:] |= cut[0][data[at : to - 1]] & cut[1][data[at + 1 : to]]
        begins = inside & (fresh | ~np.concatenate(([False], inside[:-1])))
        stops = inside & np.concatenate((fresh[1:] | ~inside[1:], [True]))
        s, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        up, down = _powers_for(to - at)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[piece] * up[: to - at], dtype=np.uint64)))
        hashes.append(mixed((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    return Words(
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        start,
        np.concatenate(ends) if ends else none,
        np.searchsorted(start, offsets),
    )


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words, and the row splits.

    A row of fewer words, but not none, has one: its whole sequence.
    """
    n = np.diff(words.splits)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    splits = np.concatenate(([0], np.cumsum(count)))
    w = words.hash
    out = np.zeros(int(splits[-1]), np.uint64)
    long = np.flatnonzero(n >= size)
    if len(long):
        total = np.zeros(max(0, len(w) - size + 1), np.uint64)
        for k in range(size):
            total += w[k : k + len(total)] * _PLACE[k]
        start = _ranges(words.splits[:-1][long], count[long])
        out[_ranges(splits[:-1][long], count[long])] = mixed(total[start] + np.uint64(size))
    for i in np.flatnonzero((n > 0) & (n < size)):
        own = w[words.splits[i] : words.splits[i + 1]]
        out[splits[i]] = mixed((own * _PLACE[: len(own)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return out, splits


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... (count[0] of them), then the same for the next."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(start - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return shift + np.arange(total)


ranges = _ranges


def row_blocks(offsets: np.ndarray, size: int):
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)
