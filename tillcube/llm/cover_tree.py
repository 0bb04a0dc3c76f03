"""Cover trees for inner products over a bounded number of points.

Every point gets one more component that brings all to one norm; then the inner product with a query falls as the distance
grows, and a node that covers its points within a radius bounds theirs from both sides. Level by level the
radius shrinks by ``BASE``: the points of a node are covered by a net of them at the smaller radius. A node of few points, or
whose points do not gather at the smaller radius, is a leaf.

A search takes all queries down a tree at once, best first: the node that promises the most of any query is next, with those
queries only that still want something inside its bounds. Leaves are worked out in full.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np

BASE = 1.3
LEAF = 64
# Of so many picked net points each must cover two others on average, or the node is a leaf.
TRIED = 48
# Bounds are widened by this share of the squared norms, far more than their rounding.
SLACK = 1e-9
EXACT = float(2**53)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: in double precision where sums stay below 2^53, else in
    the widest there is."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return a @ b.T
    return a.astype(np.longdouble) @ b.T.astype(np.longdouble)


def build(points: np.ndarray) -> dict[str, np.ndarray]:
    """A tree over rows. ``order`` puts the points of every node side by side; per node ``center`` (a row), ``begin`` and
    ``end`` in that order, ``radius``, and its ``first_child`` and ``children``, which lie side by side too.

    The first child of a node has the node's own center.
    """
    squares = (points.astype(np.float64) ** 2).sum(1)
    lifted = np.c_[points, np.sqrt(squares.max(initial=0) - squares)].astype(np.float64)
    order = np.arange(len(points))
    nodes: list[list[float]] = [[0, 0, len(points), 0, 0, 0]]
    waiting = [0]
    while waiting:
        at = waiting.pop(0)
        center, begin, end = (int(x) for x in nodes[at][:3])
        members = order[begin:end]
        far = _distances(lifted, center, members)
        nodes[at][3] = radius = float(far.max())
        if end - begin <= LEAF or radius == 0:
            continue
        cells = _net(lifted, center, members, far, radius / BASE)
        if cells is None:
            continue
        nodes[at][4:] = [len(nodes), len(cells)]
        for middle, inside in cells:
            order[begin : begin + len(inside)] = inside
            waiting.append(len(nodes))
            nodes.append([middle, begin, begin + len(inside), 0, 0, 0])
            begin += len(inside)
    table = np.array(nodes, np.float64)
    whole = table[:, [0, 1, 2, 4, 5]].astype(np.int64).T
    names = ("center", "begin", "end", "first_child", "children")
    return {"order": order, "radius": table[:, 3], **dict(zip(names, whole, strict=True))}


def _distances(lifted: np.ndarray, center: int, members: np.ndarray) -> np.ndarray:
    return np.sqrt(((lifted[members] - lifted[center]) ** 2).sum(1))


def _net(
    lifted: np.ndarray, center: int, members: np.ndarray, far: np.ndarray, radius: float
) -> list[tuple[int, np.ndarray]] | None:
    """Points that cover all members within the radius, each with what it covers first; None if they hardly gather."""
    near = far <= radius
    cells = [(center, members[near])]
    rest, covered = members[~near], 0
    while len(rest):
        middle = int(rest[0])
        near = _distances(lifted, middle, rest) <= radius
        cells.append((middle, rest[near]))
        covered += int(near.sum())
        rest = rest[~near]
        if len(cells) == TRIED and covered < 3 * TRIED:
            return None
    return cells


class Best:
    """The highest ``count`` scores of each query, of equal ones those with the lowest ids."""

    def __init__(self, queries: int, count: int):
        self.count = count
        self.floor = np.full(queries, -np.inf)
        self.query, self.place = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0), np.zeros(0, np.int64)
        self.added = 0

    def offer(self, queries: np.ndarray, scores: np.ndarray, wanted: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        """Scores of some queries (rows) with some points (columns), where wanted."""
        wanted = wanted & (scores >= self.floor[queries][:, None])
        if scores.shape[1] > 4 * self.count and wanted.sum() > 8 * self.count * len(queries):
            # The count-th of these alone is a floor already.
            own = np.partition(np.where(wanted, scores, -np.inf), -self.count, axis=1)[:, -self.count]
            wanted &= scores >= own[:, None]
        row, column = np.nonzero(wanted)
        if not len(row):
            return
        self.query = np.concatenate([self.query, queries[row]])
        self.score = np.concatenate([self.score, scores[row, column]])
        self.id = np.concatenate([self.id, ids[column]])
        self.place = np.concatenate([self.place, places[column]])
        self.added += len(row)
        if self.added > self.count * len(self.floor) // 4:
            self.settle()

    def settle(self) -> None:
        order = np.lexsort((self.place, self.id, -self.score, self.query))
        query = self.query[order]
        first = np.searchsorted(query, query)
        rank = np.arange(len(query)) - first
        order = order[rank < self.count]
        self.query, self.score, self.id, self.place = (x[order] for x in (self.query, self.score, self.id, self.place))
        full = np.flatnonzero(rank == self.count - 1)
        self.floor[query[full]] = self.score[np.searchsorted(self.query, query[full], "right") - 1]
        self.added = 0


def descend(
    tree: dict[str, np.ndarray],
    points: np.ndarray,
    queries: np.ndarray,
    may_hold: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    visit: Callable[[np.ndarray, np.ndarray, np.ndarray], None],
) -> int:
    """Take all queries down the tree. ``may_hold`` (node, queries, lower and upper bound of scores) tells which of them
    want something in the node; ``visit`` (queries, rows, scores) is given the points worked out, each once for a
    query at most. Returns how many scores were worked out."""
    squares = (points.astype(np.float64) ** 2).sum(1)
    top = squares.max(initial=0)
    query_squares = (queries.astype(np.float64) ** 2).sum(1)
    every = np.arange(len(queries))
    order, done = tree["order"], 0

    def bounds(node: int, some: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = query_squares[some] + top
        distance = np.sqrt(np.maximum(whole - 2 * scores.astype(np.float64), 0))
        slack = SLACK * whole + 1
        radius = tree["radius"][node]
        upper = (whole - np.maximum(distance - radius, 0) ** 2) / 2 + slack
        return (whole - (distance + radius) ** 2) / 2 - slack, upper

    def push(node: int, some: np.ndarray, scores: np.ndarray) -> None:
        lower, upper = bounds(node, some, scores)
        kept = may_hold(node, some, lower, upper)
        if kept.any():
            heapq.heappush(waiting, (-float(upper[kept].max()), node, some[kept], scores[kept], lower[kept], upper[kept]))

    waiting: list[tuple] = []
    root = tree["center"][:1]
    scores = products(queries, points[root])
    visit(every, root, scores)
    push(0, every, scores[:, 0])
    while waiting:
        _, node, some, own, lower, upper = heapq.heappop(waiting)
        # What was found since may have made some of them content.
        kept = may_hold(node, some, lower, upper)
        some, own = some[kept], own[kept]
        if not len(some):
            continue
        center, first, count = (int(tree[x][node]) for x in ("center", "first_child", "children"))
        if count:
            rows = tree["center"][first + 1 : first + count]
        else:
            rows = order[tree["begin"][node] : tree["end"][node]]
            rows = rows[rows != center]
        scores = products(queries[some], points[rows])
        done += scores.size
        visit(some, rows, scores)
        if count:
            push(first, some, own)
            for at in range(len(rows)):
                child = first + 1 + at
                if tree["end"][child] - tree["begin"][child] > 1:
                    push(child, some, scores[:, at])
    return done
