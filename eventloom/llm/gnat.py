"""Nearest-entry search over a small table of integer vectors by a GNAT.

A geometric near-neighbour access tree: a node keeps some entries as split
points, every other entry belongs to its nearest split point, and per pair of
split points the node keeps the range of distances from one to the entries of
the other. A query that knows its distance to a split point drops each part
whose range lies out of reach of its best distance so far, with all that is
below it.

Distances are square roots, so a range is widened and a query's distance
narrowed by more than their rounding; a part is dropped only when it is strictly
farther than the best. What is left is decided on squared distances as
integers, ties to the smaller entry number. The search is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Entries of a node that has no parts.
LEAF = 8
#: Relative widening of distances; a square root errs by 2**-53.
SLACK = 1e-12


def squared(queries: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances as 64-bit integers."""
    gap = queries - entry
    return np.einsum("ij,ij->i", gap, gap)


@dataclass
class Node:
    """Split points by entry number; per pair the nearest and farthest distance from
    split point i to part j, which holds split point j; the parts' own nodes."""

    splits: list[int]
    low: np.ndarray | None
    high: np.ndarray | None
    parts: list


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node:
    """A tree over the rows of ``entries``; the same table gives the same tree."""
    members = np.arange(len(entries)) if members is None else members
    if len(members) <= LEAF:
        return Node([int(m) for m in members], None, None, [])
    wanted = max(2, round(len(members) ** 0.5))
    splits = [int(members[0])]
    near = squared(entries[members], entries[splits[0]])
    while len(splits) < wanted and near.max() > 0:  # next the entry farthest from all split points
        splits.append(int(members[np.argmax(near)]))
        near = np.minimum(near, squared(entries[members], entries[splits[-1]]))
    if len(splits) == 1:  # all members are equal
        return Node([int(m) for m in members], None, None, [])
    distances = np.stack([squared(entries[members], entries[s]) for s in splits])
    home = np.argmin(distances, axis=0)
    home[np.searchsorted(members, splits)] = np.arange(len(splits))
    roots = np.sqrt(distances.astype(np.float64))
    low = np.stack([roots[:, home == j].min(axis=1) for j in range(len(splits))], axis=1) * (1 - SLACK)
    high = np.stack([roots[:, home == j].max(axis=1) for j in range(len(splits))], axis=1) * (1 + SLACK)
    rest = [np.setdiff1d(members[home == j], splits) for j in range(len(splits))]
    return Node(splits, low, high, [build(entries, r) if len(r) else None for r in rest])


def nearest(tree: Node, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query the nearest entry's number, the smaller on a tie, and its squared distance."""
    best = np.full(len(queries), np.iinfo(np.int64).max)
    found = np.full(len(queries), len(entries), np.int64)

    def offer(rows: np.ndarray, entry: int) -> np.ndarray:
        distance = squared(queries[rows], entries[entry])
        better = (distance < best[rows]) | ((distance == best[rows]) & (entry < found[rows]))
        taken = rows[better]
        best[taken], found[taken] = distance[better], entry
        return distance

    def visit(node: Node, rows: np.ndarray) -> None:
        if node.low is None:
            for entry in node.splits:
                offer(rows, entry)
            return
        alive = np.ones((len(rows), len(node.splits)), bool)
        for i, entry in enumerate(node.splits):
            at = np.flatnonzero(alive[:, i])
            if not len(at):
                continue
            root = np.sqrt(offer(rows[at], entry).astype(np.float64))
            reach = np.sqrt(best[rows[at]].astype(np.float64)) * (1 + SLACK)
            near, far = (root * (1 - SLACK) - reach)[:, None], (root * (1 + SLACK) + reach)[:, None]
            kept = (near <= node.high[i]) & (far >= node.low[i])
            kept[:, i] &= node.parts[i] is not None  # nothing but the split point itself
            alive[at] &= kept
        for j, part in enumerate(node.parts):
            at = np.flatnonzero(alive[:, j])
            if part is not None and len(at):
                visit(part, rows[at])

    if len(entries) and len(queries):
        visit(tree, np.arange(len(queries)))
    return found, best
