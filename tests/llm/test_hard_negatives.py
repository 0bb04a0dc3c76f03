"""Hard negatives against comparing all rows, and the cover tree's bounds."""

import math

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from tillcube.llm import cover_tree, hard_negatives
from tillcube.llm.queries import QUERIES

NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(rows):
    """Rows of (vec_id, vector, label) to rows of the query."""
    known = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        known.append((vec_id, whole, (label + 1) % 10 if vec_id % 7 == 0 else label))
    for place, (anchor, vector, label) in enumerate(known):
        if anchor % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(vector, other[1], strict=False)), other[0], other[2])
            for at, other in enumerate(known)
            if at != place
        ]
        for score, positive, _ in sorted(x for x in scored if x[2] == label)[:5]:
            hard = sorted(x for x in scored if x[2] != label and 50 * -score <= 100 * -x[0] <= 95 * -score)
            for rank, (low, negative, _) in enumerate(hard[:3], 1):
                yield anchor, positive, rank, negative, -score, -low


def result(df):
    return odd.many(tuple(row[name] for name in NAMES) for row in df.collect())


def test_odd_vectors(spark, odd_folder):
    expected = odd.many(mined(odd.vectors()))
    assert len(expected) > 50
    assert result(QUERIES["op13_hard_negatives"](spark, odd_folder)) == expected


def test_blocks_of_anchors_and_small_trees(spark, monkeypatch):
    draw = np.random.default_rng(3)
    middles = draw.normal(size=(12, 8))
    rows = [(at, (middles[at % 12] + draw.normal(size=8) * 0.1).astype(np.float32).tolist(), at % 5) for at in range(2500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(table, F.col("vec_id") % 50 == 0, label, block_bytes=3000)
    assert result(found) == odd.many(mined(rows))


@pytest.mark.parametrize("spread", [0.0, 0.02, 0.2, 5.0])
def test_nodes_cover_their_points_and_bounds_hold(spread):
    draw = np.random.default_rng(4)
    points = np.floor(256 * (draw.normal(size=(20, 6)).repeat(40, 0) + draw.normal(size=(800, 6)) * spread))
    tree = cover_tree.build(points)
    assert sorted(tree["order"].tolist()) == list(range(800))
    for node in range(len(tree["center"])):
        members = tree["order"][tree["begin"][node] : tree["end"][node]]
        first, count = tree["first_child"][node], tree["children"][node]
        if count:
            children = range(first, first + count)
            assert tree["center"][first] == tree["center"][node]
            spans = [(tree["begin"][x], tree["end"][x]) for x in children]
            assert spans[0][0] == tree["begin"][node] and spans[-1][1] == tree["end"][node]
            assert all(a[1] == b[0] for a, b in zip(spans[:-1], spans[1:], strict=True))
            assert all(tree["radius"][x] <= tree["radius"][node] / cover_tree.BASE + 1e-6 for x in children)
        assert tree["center"][node] in members
    queries = np.floor(256 * draw.normal(size=(15, 6)))
    scores = queries @ points.T
    seen = np.zeros(scores.shape, int)

    def holds(node, some, lower, upper):
        inside = scores[np.ix_(some, tree["order"][tree["begin"][node] : tree["end"][node]])]
        assert (inside.max(1) <= upper).all() and (inside.min(1) >= lower).all()
        return np.ones(len(some), bool)

    def visit(some, rows, found):
        assert (found == scores[np.ix_(some, rows)]).all()
        seen[np.ix_(some, rows)] += 1

    cover_tree.descend(tree, points, queries, holds, visit)
    assert (seen == 1).all()


def test_bounds_shut_out_most_of_gathered_points():
    draw = np.random.default_rng(5)
    points = np.floor(256 * (draw.normal(size=(16, 8)).repeat(125, 0) + draw.normal(size=(2000, 8)) * 0.01))
    queries = points[::100]
    best = cover_tree.Best(len(queries), 3)
    every = np.arange(2000)
    done = cover_tree.descend(
        cover_tree.build(points), points, queries,
        lambda node, some, lower, upper: upper >= best.floor[some],
        lambda some, rows, scores: best.offer(some, scores, np.ones(scores.shape, bool), rows, rows),
    )
    best.settle()
    for query in range(len(queries)):
        scores = points @ queries[query]
        assert best.id[best.query == query].tolist() == np.lexsort((every, -scores))[:3].tolist()
    assert done < 0.4 * len(queries) * len(points)


def test_scores_beyond_double_precision_are_exact():
    a = np.array([[2.0**30 + 1, 3.0], [1.0, 0.0]])
    assert int(cover_tree.products(a, a)[0, 0]) == (2**30 + 1) ** 2 + 9
