"""A forest of random-projection trees and its search through one priority queue."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """Inner nodes by number: plane, offset, children. A child below zero is leaf -child-1."""

    plane: np.ndarray
    offset: np.ndarray
    child: np.ndarray
    leaves: int

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point falls into."""
        if not len(self.plane):
            return np.zeros(len(points), np.int64)
        out, at = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        left = np.arange(len(points))
        while len(left):
            node = at[left]
            side = (np.einsum("ij,ij->i", points[left], self.plane[node]) <= self.offset[node]).astype(np.int64)
            nxt = self.child[node, side]
            done = nxt < 0
            out[left[done]] = -nxt[done] - 1
            at[left] = nxt
            left = left[~done]
        return out


def grow(points: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    """Splits by the plane between two centres of a few random points, until leaves are small
    or their points cannot be told apart."""
    planes, offsets, children, leaves = [], [], [], 0
    todo = [(np.arange(len(points)), None)]
    while todo:
        rows, parent = todo.pop()
        split = _plane(points, rows, rng) if len(rows) > leaf_rows else None
        if split is None:
            me, leaves = -leaves - 1, leaves + 1
        else:
            me = len(planes)
            planes.append(split[0])
            offsets.append(split[1])
            children.append([0, 0])
            high = points[rows] @ split[0] > split[1]
            todo += [(rows[high], (me, 0)), (rows[~high], (me, 1))]
        if parent is not None:
            children[parent[0]][parent[1]] = me
    d = points.shape[1]
    return Tree(np.array(planes).reshape(-1, d), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), leaves)


def _plane(points: np.ndarray, rows: np.ndarray, rng: np.random.Generator):
    for _ in range(3):
        some = points[rng.choice(rows, min(256, len(rows)), replace=False)]
        a, b = some[0], some[-1]
        for _ in range(4):
            near = ((some - a) ** 2).sum(1) < ((some - b) ** 2).sum(1)
            if near.all() or not near.any():
                break
            a, b = some[near].mean(0), some[~near].mean(0)
        plane = a - b
        length = np.linalg.norm(plane)
        if length < 1e-12:
            continue
        plane = plane / length
        offset = float(plane @ (a + b) / 2)
        share = (points[rows] @ plane > offset).mean()
        if 0.02 < share < 0.98:
            return plane, offset
    return None


def search(trees: list[Tree], point: np.ndarray, weight_in: list[np.ndarray], enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs, nearest planes first over all trees, until they weigh ``enough``."""
    side = [t.plane @ point - t.offset for t in trees]
    queue = [(-np.inf, k, 0 if len(t.plane) else -1) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    out, weight = [], 0.0
    while queue and weight < enough:
        far, k, node = heapq.heappop(queue)
        if node < 0:
            out.append((k, -node - 1))
            weight += float(weight_in[k][-node - 1])
            continue
        margin = side[k][node]
        for way, distance in ((0, -margin), (1, margin)):
            heapq.heappush(queue, (max(far, distance), k, int(trees[k].child[node, way])))
    return out
