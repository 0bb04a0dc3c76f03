"""BK-trees over fingerprints of one or more 64-bit words, many trees at a time.

A child hangs on its parent by an edge that bears their Hamming distance; no two edges of a node bear the same.
All fingerprints at distance d from a node lie below its edge d, so a search within a radius r that meets a node at
distance x has to follow the edges x - r to x + r only.
"""

from __future__ import annotations

import numpy as np

# Room for a distance in the key of an edge.
EDGE_BITS = 12
# Pairs of query and node looked at in one step.
STEP_PAIRS = 4_000_000


class Forest:
    """One BK-tree per group of equal ``tree`` numbers, whose ``prints`` lie side by side. ``prints`` are unsigned 64-bit
    numbers, or rows of several."""

    def __init__(self, prints: np.ndarray, tree: np.ndarray):
        self.prints = prints
        count = len(prints)
        begins = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if count else np.zeros(0, np.int64)
        self.root = np.repeat(begins, np.diff(np.r_[begins, count]))
        parent = self.root.copy()
        open_ = np.flatnonzero(np.arange(count) != self.root)
        keys, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(open_):
            edge = self._edge(parent[open_], self._distance(open_, parent[open_]))
            order = np.argsort(edge, kind="stable")
            edge, open_ = edge[order], open_[order]
            first = np.r_[True, edge[1:] != edge[:-1]]
            keys.append(edge[first])
            nodes.append(open_[first])
            # The first of an edge is its child; the others go down to it.
            parent[open_] = np.repeat(open_[first], np.diff(np.r_[np.flatnonzero(first), len(edge)]))
            open_ = open_[~first]
        edges, nodes = np.concatenate(keys), np.concatenate(nodes)
        order = np.argsort(edges)
        self.edges, self.nodes = edges[order], nodes[order]

    def _distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        different = np.bitwise_count(self.prints[a] ^ self.prints[b])
        return (different if different.ndim == 1 else different.sum(1)).astype(np.int64)

    @staticmethod
    def _edge(node: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return (node << EDGE_BITS) | distance

    def within(self, radius: int, queries: np.ndarray | None = None):
        """Yield (query, node) arrays of prints of one tree at most ``radius`` bits apart."""
        queries = np.arange(len(self.prints)) if queries is None else queries
        waiting = [(queries, self.root[queries])]
        while waiting:
            query, node = waiting.pop()
            if len(query) > STEP_PAIRS:
                half = len(query) // 2
                waiting += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            distance = self._distance(query, node)
            hit = (distance <= radius) & (query != node)
            if hit.any():
                yield query[hit], node[hit]
            lo = np.searchsorted(self.edges, self._edge(node, np.maximum(distance - radius, 0)))
            hi = np.searchsorted(self.edges, self._edge(node, distance + radius), "right")
            below = hi - lo
            if below.sum() > STEP_PAIRS and len(query) > 1:
                half = len(query) // 2
                for part in (slice(None, half), slice(half, None)):
                    waiting.append(self._children(query[part], lo[part], below[part]))
            elif below.any():
                waiting.append(self._children(query, lo, below))

    def _children(self, query: np.ndarray, lo: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(below)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - below), below)
        return np.repeat(query, below), self.nodes[at]


def lowest_linked(count: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``count`` nodes the lowest node that links join it to."""
    label = np.arange(count)
    if not links:
        return label
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label
