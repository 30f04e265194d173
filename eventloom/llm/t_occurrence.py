"""T-occurrence search in one block: which sets share at least T elements with a query.

DivideSkip: the longest inverted lists are set aside; the short ones are merged
with a heap that skips ahead wherever too few lists can still agree; what
reaches the lowered threshold is looked up in the long lists by binary search.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left

import numpy as np

#: Weight of the longest list's length when lists are set aside as long.
MU = 0.01


def occurring(lists: list[list[int]], least: int) -> dict[int, int]:
    """Set number -> how many lists hold it, for those that ``least`` (at least 1) or more hold."""
    if len(lists) < least:
        return {}
    lists = sorted(lists, key=len, reverse=True)
    apart = min(least - 1, int(least / (MU * math.log2(max(2, len(lists[0]))) + 1)))
    long, short, need = lists[:apart], lists[apart:], least - apart
    heap = [(x[0], k) for k, x in enumerate(short)]
    heapq.heapify(heap)
    at = [0] * len(short)
    out: dict[int, int] = {}
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= need:
            count, left = len(popped), len(long)
            for x in long:
                i = bisect_left(x, top)
                count += i < len(x) and x[i] == top
                left -= 1
                if count + left < least:
                    break
            if count >= least:
                out[top] = count
            ahead = top + 1
        else:
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            ahead = heap[0][0]  # what lies before it is in fewer than ``need`` short lists
        for k in popped:
            x = short[k]
            at[k] = bisect_left(x, ahead, at[k])
            if at[k] < len(x):
                heapq.heappush(heap, (x[at[k]], k))
    return out


class InvertedIndex:
    """Element -> ordered numbers of the sets that hold it, for one block of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.owner, every = owner[order], every[order]
        self.element, start = np.unique(every, return_index=True)
        self.start = np.append(start, len(every))

    def linked(self, query: np.ndarray, percent: int) -> list[int]:
        """Numbers of the sets with 100 * shared >= percent * union."""
        if not len(self.element):
            return []
        at = np.minimum(np.searchsorted(self.element, query), len(self.element) - 1)
        at = at[self.element[at] == query]
        lists = [self.owner[a:b].tolist() for a, b in zip(self.start[at], self.start[at + 1], strict=True)]
        found = occurring(lists, max(1, -(-percent * len(query) // 100)))
        return sorted(i for i, shared in found.items() if 100 * shared >= percent * (len(query) + self.sizes[i] - shared))
