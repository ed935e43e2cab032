"""Vantage-point trees over 32-bit halves of fingerprints, and exact links in a tile."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class VpTree:
    """Inner nodes by number; a child below zero is leaf ``-child - 1``."""

    vantage: np.ndarray
    radius: np.ndarray
    children: np.ndarray
    leaves: int

    def visits(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that may hold a point within ``reach``.

        By the triangle inequality a point at distance d from the vantage has its
        neighbours between d - reach and d + reach, so the inner side is pruned
        if d - reach is past the radius and the outer side if d + reach is not.
        """
        rows, leaves = [], []
        todo = [(0 if len(self.vantage) else -1, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                leaves.append(np.full(len(at), -node - 1))
                continue
            away = np.bitwise_count(points[at] ^ self.vantage[node]).astype(np.int64)
            todo.append((int(self.children[node, 0]), at[away - reach <= self.radius[node]]))
            todo.append((int(self.children[node, 1]), at[away + reach > self.radius[node]]))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(leaves)


def build(sample: np.ndarray, leaves: int, reach: int, seed: int = 7) -> VpTree:
    """Split ``sample`` until there are about ``leaves`` parts of equal size.

    Of a few vantage points the one is taken whose larger side, boundary
    included, is smallest. Points that no radius tells apart stay together.
    """
    rng = np.random.default_rng(seed)
    least = max(4, len(sample) // max(leaves, 1))
    vantage, radius, children, n_leaves = [], [], [], 0

    def grow(points: np.ndarray) -> int:
        nonlocal n_leaves
        best = None
        if len(points) > least:
            for v in rng.choice(points, size=min(12, len(points)), replace=False):
                away = np.bitwise_count(points ^ v).astype(np.int64)
                r = int(np.median(away))
                for r in (r - 1, r):
                    inside, outside = away <= r, away > r
                    if inside.any() and outside.any():
                        cost = max((away - reach <= r).sum(), (away + reach > r).sum())
                        if best is None or cost < best[0]:
                            best = (cost, v, r, inside)
        if best is None or best[0] >= len(points):
            n_leaves += 1
            return -n_leaves
        node = len(vantage)
        vantage.append(best[1])
        radius.append(best[2])
        children.append([0, 0])
        children[node] = [grow(points[best[3]]), grow(points[~best[3]])]
        return node

    grow(sample)
    return VpTree(
        np.array(vantage, np.uint32),
        np.array(radius, np.int64),
        np.array(children, np.int64).reshape(-1, 2),
        max(n_leaves, 1),
    )


def link(queries: np.ndarray, data: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join all fingerprints linked within the tile: each to the least of its class."""
    nodes = np.unique(np.concatenate([queries, data]))
    q_at, d_at = np.searchsorted(nodes, queries), np.searchsorted(nodes, data)
    parent = np.arange(len(nodes))
    step = max(1, (1 << 21) // max(len(queries), 1))
    for a in range(0, len(data), step):
        near = np.bitwise_count(data[a : a + step, None] ^ queries[None, :]) <= most_bits
        i, j = np.nonzero(near)
        i, j = d_at[a + i], q_at[j]
        while len(i):
            ri, rj = parent[i], parent[j]
            apart = ri != rj
            i, j, ri, rj = i[apart], j[apart], ri[apart], rj[apart]
            np.minimum.at(parent, np.maximum(ri, rj), np.minimum(ri, rj))
            while not np.array_equal(up := parent[parent], parent):
                parent = up
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[moved], nodes[parent[moved]]
