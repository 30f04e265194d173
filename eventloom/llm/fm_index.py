"""Full-text index of one shard of words: suffix order, its transform, ranks, samples.

A shard is a sequence of symbols. Symbol 0 is a break: a word that no phrase
holds, or the end of a text. Phrases never hold a break, so each break counts
as a symbol of its own, in text order, and suffix ties end at the next one.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 8


class WaveletMatrix:
    """Symbols by bit planes, highest bit first; rank of a symbol in planes steps."""

    def __init__(self, symbols: np.ndarray, planes: int):
        self.n, self.planes = len(symbols), max(1, planes)
        self.zeros_before, self.ones_from = [], []
        now = symbols
        for plane in range(self.planes - 1, -1, -1):
            bit = (now >> plane) & 1
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(1 - bit, out=before[1:])
            self.zeros_before.append(before)
            self.ones_from.append(int(before[-1]))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``."""
        low, high = np.zeros_like(at), at
        for level, (before, ones) in enumerate(zip(self.zeros_before, self.ones_from, strict=True)):
            one = ((symbol >> (self.planes - 1 - level)) & 1).astype(bool)
            low0, high0 = before[low], before[high]
            low = np.where(one, ones + low - low0, low0)
            high = np.where(one, ones + high - high0, high0)
        return high - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        """The symbols at these places."""
        out = np.zeros(len(at), np.int64)
        for before, ones in zip(self.zeros_before, self.ones_from, strict=True):
            zeros = before[at]
            one = before[at + 1] == zeros
            out = out * 2 + one
            at = np.where(one, ones + at - zeros, zeros)
        return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start of each suffix in order, by prefix doubling over the ties that are left.

    The last symbol must be a break.
    """
    n, breaks = len(symbols), symbols == 0
    rank = symbols.astype(np.int64) + int(breaks.sum())
    rank[breaks] = np.arange(int(breaks.sum()))
    order = np.argsort(rank, kind="stable")
    place, rank = _regroup(rank[order], np.arange(n)), rank
    rank = np.empty(n, np.int64)
    rank[order] = place
    slots, reach = np.arange(n), 1
    while True:
        tied = np.flatnonzero(_in_a_tie(rank[order[slots]]))
        if not len(tied):
            return order
        slots = slots[tied]
        starts = order[slots]
        key = rank[starts] * (n + 1) + rank[starts + reach]
        by = np.argsort(key, kind="stable")
        starts = starts[by]
        order[slots] = starts
        rank[starts] = _regroup(key[by], slots)
        reach *= 2


def _in_a_tie(ranks: np.ndarray) -> np.ndarray:
    same = ranks[1:] == ranks[:-1]
    return np.concatenate((same, [False])) | np.concatenate(([False], same))


def _regroup(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For sorted keys the slot at which each run of equal keys begins."""
    fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
    return slots[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]


class FMIndex:
    """Counts and finds phrases in a shard of symbols 0 to ``top``."""

    def __init__(self, symbols: np.ndarray, top: int):
        symbols = np.concatenate((symbols, [0])).astype(np.int64)
        order = suffix_order(symbols)
        before = symbols[order - 1]  # the suffix at 0 is preceded by the closing break
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=top + 1))))
        self.waves = WaveletMatrix(before, int(top).bit_length())
        kept = (before == 0) | (order % SAMPLE_EVERY == 0)
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.kept_start = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last row of each phrase; phrases are filled up to the right."""
        n = len(phrases)
        low, high = np.zeros(n, np.int64), np.full(n, self.smaller[-1])
        alive = np.arange(n)
        for step in range(int(lengths.max()) if n else 0):
            alive = alive[low[alive] < high[alive]]
            now = alive[lengths[alive] > step]
            if not len(now):
                break
            c = phrases[now, lengths[now] - 1 - step]
            if step == 0:
                low[now], high[now] = self.smaller[c], self.smaller[c + 1]
            else:
                low[now] = self.smaller[c] + self.waves.rank(c, low[now])
                high[now] = self.smaller[c] + self.waves.rank(c, high[now])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start: step back to the next sampled one."""
        out, steps, left = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(left):
            at = rows[left]
            kept = self.kept_before[at + 1] > self.kept_before[at]
            out[left[kept]] = self.kept_start[self.kept_before[at[kept]]] + steps
            left, at = left[~kept], at[~kept]
            c = self.waves.symbol(at)
            rows[left] = self.smaller[c] + self.waves.rank(c, at)
            steps += 1
        return out
