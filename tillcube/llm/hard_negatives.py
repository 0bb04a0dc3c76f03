"""Hard negatives: rows of another label whose score with an anchor lies in a window below that of a positive.

Components become whole numbers (``SCALE`` times the component, rounded down), so scores are exact and ties real. Rows are
dealt by ranges of label and of the signs of their first components, so that those of a tree are near each other, and
each task builds cover trees of at most ``TREE_ROWS`` rows; a label or a spot that holds a third of the rows is many trees.
The trees are written once, a row each.

Anchors are numbered and searched in blocks that take ``BLOCK_BYTES`` at most, whatever the number of rows: a block goes to
every task, which takes it down its trees, one after the other, with the best scores so far as a bound. Each task gives
back the few best of every anchor, and a window ranks those of all tasks. First come the positives (same label), whose
scores set the windows, then the negatives. Every row is compared or shut out by a bound; nothing is dropped.

Defined cases: rows without an id (they could not be named), label or vector, or with a missing, infinite or undefined
component take no part; components that a shorter vector lacks count as 0; rows that share an id are rows of their own, and
a row is never its own positive; a score of 0 or less leaves at most its own window of one value or none; scores past 64 bits
count as the largest number; an anchor without a positive or a negative gives no rows, and neither does an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcube.llm.cover_tree import Best, build, descend
from tillcube.llm.tables import running_sums
from tillcube.sources.shared import materialize, new_path

SCALE = 256
TREE_ROWS = 2_048
BLOCK_BYTES = 16 << 20
# Components whose signs tell which rows lie near each other.
SIGNS = 12
POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95
LONGEST = 2**63 - 1025

POINTS = "key long, vec_id long, label long, vector array<double>"
NODES = ("center", "begin", "end", "first_child", "children", "order")
TREES = (
    "keys array<long>, ids array<long>, labels array<long>, vectors array<double>, radius array<double>, "
    + ", ".join(f"{name} array<int>" for name in NODES)
)
FOUND = "anchor long, window int, score long, vec_id long, key long"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def finite_vector(vector: Column) -> Column:
    """Components as double; null where one is missing or not finite."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(finite, numbers)


def points(rows: DataFrame, label: Column, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``key``, ``vec_id``, ``label`` and the scaled ``vector`` of the rows that take part, dealt by label and place, and
    written. ``key`` tells rows of one id apart."""
    own = rows.select(
        rows[id_column].cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        finite_vector(rows[vector_column]).alias("vector"),
    ).dropna()
    signs = F.aggregate(F.slice("vector", 1, SIGNS), F.lit(0), lambda bits, x: bits * 2 + (x < 0).cast("int"))
    dealt = own.withColumn("signs", signs).repartitionByRange("label", "signs", "vec_id")
    keyed = dealt.sortWithinPartitions("label", "signs", "vec_id").withColumn("key", F.monotonically_increasing_id())
    scaled = F.transform("vector", lambda x: x * scale)
    return materialize(keyed.select("key", "vec_id", "label", scaled.alias("vector")), "points")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros, rounded down."""
    sizes = np.diff(np.asarray(lists.offsets))
    values = np.floor(np.asarray(lists.flatten(), np.float64))
    if (sizes == width).all():
        return values.reshape(len(lists), width)
    out = np.zeros((len(lists), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _grow(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tree. What is left of a batch waits for the next."""
    schema = pa.schema([(x.split()[0], _list_type(x.split()[1])) for x in TREES.split(", ")])
    rest = None

    def tree(part: pa.RecordBatch) -> pa.RecordBatch:
        vectors = _matrix(part.column("vector"), width)
        nodes = build(vectors)
        values = {"keys": part.column("key"), "ids": part.column("vec_id"), "labels": part.column("label")}
        values |= {"vectors": vectors.ravel(), **nodes}
        columns = [pa.array([np.asarray(values[x.name])], x.type) for x in schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        joined = table.to_batches()[0] if table.num_rows else batch
        while joined.num_rows >= TREE_ROWS:
            yield tree(joined.slice(0, TREE_ROWS))
            joined = joined.slice(TREE_ROWS)
        rest = joined
    if rest is not None and rest.num_rows:
        yield tree(rest)


def _list_type(name: str) -> pa.DataType:
    return pa.list_({"array<long>": pa.int64(), "array<int>": pa.int32(), "array<double>": pa.float64()}[name])


class Search:
    """Takes one block of anchors down trees of a task."""

    def __init__(self, block: dict[str, np.ndarray], count: int, windows: int):
        self.vectors, self.labels, self.keys = block["vectors"], block["labels"], block["keys"]
        self.low, self.high = block.get("low"), block.get("high")
        self.count, self.windows = count, windows
        self.best = Best(len(self.keys) * windows, count)

    def wants(self, node: int, some: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        first, last = self.first_label[node], self.last_label[node]
        if self.low is None:
            return (self.labels[some] >= first) & (self.labels[some] <= last) & (upper >= self.best.floor[some])
        floors = np.maximum(self.best.floor.reshape(-1, self.windows)[some], self.low[some])
        inside = (upper[:, None] >= floors) & (lower[:, None] <= self.high[some])
        return inside.any(1) & ~((self.labels[some] == first) & (self.labels[some] == last))

    def visit(self, some: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
        same = self.labels[some][:, None] == self.tree_labels[rows][None]
        if self.low is None:
            wanted = same & (self.keys[some][:, None] != self.tree_keys[rows][None])
            self.best.offer(some, scores, wanted, self.tree_ids[rows], self.tree_keys[rows])
            return
        for window in range(self.windows):
            low, high = self.low[some, window][:, None], self.high[some, window][:, None]
            wanted = ~same & (scores >= low) & (scores <= high)
            queries = some * self.windows + window
            self.best.offer(queries, scores, wanted, self.tree_ids[rows], self.tree_keys[rows])

    def through(self, row: dict[str, np.ndarray]) -> None:
        nodes = {name: row[name].astype(np.int64) for name in NODES} | {"radius": row["radius"]}
        self.tree_keys, self.tree_ids, self.tree_labels = row["keys"], row["ids"], row["labels"]
        ordered = self.tree_labels[nodes["order"]]
        spans = list(zip(nodes["begin"].tolist(), nodes["end"].tolist(), strict=True))
        self.first_label = np.array([ordered[a:b].min() for a, b in spans])
        self.last_label = np.array([ordered[a:b].max() for a, b in spans])
        vectors = row["vectors"].reshape(len(self.tree_keys), -1)
        descend(nodes, vectors, self.vectors, self.wants, self.visit)

    def found(self) -> pa.RecordBatch:
        best = self.best
        best.settle()
        score = np.clip(best.score, -LONGEST, LONGEST).astype(np.int64)
        columns = [self.keys[best.query // self.windows], best.query % self.windows, score, best.id, best.place]
        columns[1] = columns[1].astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _names(FOUND))


def _search(sent: Broadcast, count: int, windows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    search = None
    for batch in batches:
        for at in range(batch.num_rows):
            search = search or Search(sent.value, count, windows)
            columns = {name: batch.column(name).slice(at, 1).flatten() for name in batch.schema.names}
            search.through({name: np.asarray(values) for name, values in columns.items()})
    if search:
        yield search.found()


def _best_of_all(trees: DataFrame, block: dict[str, np.ndarray], count: int, windows: int) -> DataFrame:
    """``FOUND`` rows with their ``rank`` among those of the same anchor and window."""
    sent = trees.sparkSession.sparkContext.broadcast(block)
    found = trees.mapInArrow(partial(_search, sent, count, windows), FOUND)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _block(rows: pa.Table, width: int) -> dict[str, np.ndarray]:
    vectors = _matrix(rows.column("vector").combine_chunks(), width)
    return {"keys": np.asarray(rows.column("key")), "labels": np.asarray(rows.column("label")), "vectors": vectors}


def _windows(block: dict[str, np.ndarray], positives: pa.Table, count: int, lowest: int, highest: int) -> dict[str, np.ndarray]:
    """The block with the bounds of its negatives' scores; an anchor has a window per positive."""
    order = np.argsort(block["keys"])
    row = order[np.searchsorted(block["keys"], np.asarray(positives.column("anchor")), sorter=order)]
    at = np.asarray(positives.column("rank")) - 1
    low, high = np.full((len(order), count), np.inf), np.full((len(order), count), -np.inf)
    score = np.asarray(positives.column("score")).astype(object)
    low[row, at] = np.array([-(-lowest * x // 100) for x in score.tolist()], np.float64)
    high[row, at] = np.array([highest * x // 100 for x in score.tolist()], np.float64)
    return block | {"low": low, "high": high}


def mine(
    rows: DataFrame,
    anchors: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``anchors`` is a condition on ``vec_id``. For each of an anchor's first ``positives`` rows of the same label come the
    first ``negatives`` rows of other labels whose score is from ``lowest`` to ``highest`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    all_points = points(rows, rows["label"] if label is None else label, scale, id_column, vector_column)
    width = all_points.agg(F.max(F.size("vector"))).first()[0] or 0
    trees = materialize(all_points.mapInArrow(partial(_grow, max(width, 1)), TREES), "trees")
    chosen = all_points.where(anchors).withColumn("one", F.lit(1).cast("long"))
    numbered, _ = running_sums(chosen, [F.col("key")], ["one"], "anchors")
    # As many anchors as fit into the bytes, so the size of what is sent does not depend on the table.
    per_block = max(1, block_bytes // (8 * (max(width, 1) + 2 * positives)))
    numbered = materialize(numbered.withColumn("block", F.floor(F.col("one_before") / per_block)), "anchor_blocks")
    last = numbered.agg(F.max("block")).first()[0]
    path = new_path(spark, "hard_negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for number in range(0 if last is None else last + 1):
        own = numbered.where(F.col("block") == number)
        block = _block(own.select("key", "label", "vector").toArrow(), max(width, 1))
        best = materialize(_best_of_all(trees, block, positives, 1), "positives")
        found = best.select("anchor", "rank", "score").toArrow()
        if not found.num_rows:
            continue
        block = _windows(block, found, positives, lowest, highest)
        hard = _best_of_all(trees, block, negatives, positives)
        hard = hard.select(
            "anchor", F.col("window").alias("at"), "rank", F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        )
        near = best.select(
            "anchor", (F.col("rank") - 1).alias("at"), F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        names = own.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        joined = hard.join(near, ["anchor", "at"]).join(names, "anchor")
        joined.select(*_names(schema)).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
