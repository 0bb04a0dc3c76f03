"""Merkle manifest of a table: a digest that proves every row, with short proofs.

A row is a leaf. The leaves of a group (a source) stand in order, runs of ``WIDTH`` nodes have one parent, and so on up to
one node, the group's root; the groups' roots, in order of the groups, make one more tree, whose root stands for the table.

Only every ``EVERY``-th level is written, as aligned blocks: the up to WIDTH^EVERY nodes below one node of the next
written level are one row. Building reads a written level block by block and writes the one node above each block. Proofs
go down from the root: each block meets what its node has above it, works out the levels in between again from
the stored digests, hands every node its siblings on the way, and drops them. A block has a fixed number of nodes, so a
source that holds a third of all rows is many blocks; no task holds a group, and sources are never collected.

Defined cases: a null is written as such in a leaf, apart from every text; a null source is a group of its own, the
first; rows without id come first in their source; rows that share an id stand in order of their leaves, and rows that are
equal throughout are leaves side by side; columns that are not named are no part of a leaf; a group of one row has its leaf
as its root; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.llm.tables import running_sums
from tillcube.sources.shared import materialize

WIDTH = 16
EVERY = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SIBLINGS = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value so that no two rows look the same side by side: its length in bytes before it."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


@dataclass(frozen=True)
class Tree:
    """Trees of one kind. ``levels`` are the written ones, leaves first: rows (``tree``, ``nodes``: how many leaves it
    has, ``block``, ``items``: its nodes with their ``digest``). ``roots`` has one row per tree."""

    levels: list[DataFrame]
    roots: DataFrame
    width: int
    every: int

    @property
    def span(self) -> int:
        return self.width**self.every


@dataclass(frozen=True)
class Manifest:
    rows: Tree
    groups: Tree
    carried: tuple[str, ...]

    @property
    def root(self) -> DataFrame:
        """One row (none for an empty table): ``root``."""
        return self.groups.roots.select(F.col("digest").alias("root"))


def _above(digests: Column, nodes: Column, level: int, width: int) -> Column:
    """Digests one level up; of a tree that has one node on this level, that node."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / width).cast("int"))
    joined = F.transform(runs, lambda run: F.sha2(F.array_join(F.slice(digests, run * width + 1, F.lit(width)), ""), 256))
    return F.when(nodes > width**level, joined).otherwise(digests)


def _regenerated(blocks: DataFrame, step: int, width: int, levels: int) -> DataFrame:
    """Blocks of written level ``step`` with the digests of it and of the levels above it, ``level_0`` and so on."""
    blocks = blocks.withColumn("level_0", F.transform("items", lambda item: item["digest"]))
    for level in range(1, levels):
        below = F.col(f"level_{level - 1}")
        at = step + level - 1
        blocks = blocks.withColumn(f"level_{level}", _above(below, F.col("nodes"), at, width))
    return blocks


def _blocks(placed: DataFrame, span: int, label: str) -> DataFrame:
    """Rows of ``tree``, ``nodes``, ``place`` and ``item`` put into blocks, which hold ``span`` items at most."""
    block = F.floor(F.col("place") / span).cast("long").alias("block")
    items = F.array_sort(F.collect_list(F.struct("place", "item")))
    dealt = placed.groupBy("tree", "nodes", block).agg(items.alias("placed"))
    return materialize(dealt.select("tree", "nodes", "block", F.transform("placed", lambda x: x["item"]).alias("items")), label)


def _grown(placed: DataFrame, largest: int, width: int, every: int, label: str) -> Tree:
    levels = [_blocks(placed, width**every, f"{label}_0")]
    while True:
        step = every * (len(levels) - 1)
        tops = _regenerated(levels[-1], step, width, every + 1)
        node = F.struct(F.element_at(f"level_{every}", 1).alias("digest")).alias("item")
        nodes = tops.select("tree", "nodes", F.col("block").alias("place"), node)
        if width ** (step + every) >= largest:
            roots = nodes.select("tree", F.col("item.digest").alias("digest"))
            return Tree(levels, materialize(roots, f"{label}_roots"), width, every)
        levels.append(_blocks(nodes, width**every, f"{label}_{len(levels)}"))


def _placed(leaves: DataFrame, order: Sequence[Column], label: str) -> tuple[DataFrame, int]:
    """Rows of ``tree`` and ``item`` with their ``place`` in the tree and its number of ``nodes``, and the most nodes of a
    tree. Rows are dealt by ranges of tree and order, so that a large tree fills many."""
    ranked, _ = running_sums(leaves.withColumn("one", F.lit(1).cast("long")), [F.col("tree"), *order], ["one"], label)
    ranked = ranked.withColumnRenamed("one_before", "rank").drop("one", "part")
    # One row per tree; written, so that the join below knows how few they are.
    sizes = materialize(
        ranked.groupBy("tree").agg(F.min("rank").alias("first"), F.count("*").alias("nodes")), f"{label}_sizes"
    )
    largest = sizes.agg(F.max("nodes")).first()[0] or 0
    placed = ranked.join(sizes, "tree").select("tree", "nodes", (F.col("rank") - F.col("first")).alias("place"), "item")
    return placed, largest


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    id_column: str = "doc_id",
    carried: dict[str, Column] | None = None,
    width: int = WIDTH,
    every: int = EVERY,
) -> Manifest:
    """The trees of a table. ``carried`` are further expressions over its columns that stay beside each leaf."""
    if width < 2 or every < 1:
        raise ValueError("a node has two children or more, and a level or more is worked out again")
    carried = carried or {}
    source = docs[group].cast("string")
    leaves = docs.select(
        # A null group comes before all others.
        F.coalesce(F.concat(F.lit("s"), source), F.lit("")).alias("tree"),
        F.struct(
            leaf(*[docs[name] for name in fields]).alias("digest"),
            docs[id_column].cast("long").alias("doc_id"),
            *[value.alias(name) for name, value in carried.items()],
        ).alias("item"),
    )
    # Written before they are ordered, so that no text is read or hashed twice, and none is moved.
    leaves = materialize(leaves, "leaves")
    order = [F.col("item.doc_id").asc_nulls_first(), F.col("item.digest"), F.col("item")]
    rows = _grown(*_placed(leaves, order, "leaves_in_order"), width, every, "manifest_rows")
    groups = rows.roots.select(F.lit("").alias("tree"), F.struct("digest", F.col("tree").alias("key")).alias("item"))
    placed = _placed(groups, [F.col("item.key")], "groups_in_order")
    return Manifest(rows, _grown(*placed, width, every, "manifest_groups"), tuple(carried))


def _run(digests: Column, index: Column, width: int) -> Column:
    """Siblings of a node: the digests before it and after it in its run."""
    inside = index % width
    return F.struct(
        F.array_join(F.slice(digests, index - inside + 1, inside), "").alias("before"),
        F.array_join(F.slice(digests, index + 2, width - 1 - inside), "").alias("after"),
    )


def _with_siblings(tree: Tree, step: int) -> Callable[[Column, Column], Column]:
    """An item of a block of written level ``step``, its place and its siblings up to the root."""

    def found(item: Column, index: Column) -> Column:
        own = []
        for level in range(tree.every):
            run = _run(F.col(f"level_{level}"), F.floor(index / tree.width**level).cast("int"), tree.width)
            own.append(F.when(F.col("nodes") > tree.width ** (step + level), run))
        place = F.col("block") * tree.span + index
        siblings = F.concat(F.array_compact(F.array(*own)), F.col("tail"))
        return F.struct(item.alias("item"), place.alias("place"), siblings.alias("tail"))

    return found


def _down(tree: Tree, tops: DataFrame) -> DataFrame:
    """Every leaf item with its ``siblings``, the lowest first, and what ``tops`` (``tree``, ``place``, ``tail``, ``above``)
    says of its tree."""
    tails = tops
    for at in reversed(range(len(tree.levels))):
        step = tree.every * at
        meeting = tails.withColumnRenamed("place", "block")
        blocks = _regenerated(tree.levels[at], step, tree.width, tree.every).join(meeting, ["tree", "block"])
        tails = blocks.select("tree", "above", F.inline(F.transform("items", _with_siblings(tree, step))))
        if at:
            tails = materialize(tails.select("tree", "place", "tail", "above"), "manifest_tails")
    return tails.select("tree", "item", F.col("tail").alias("siblings"), "above")


def proofs(manifest: Manifest) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root`` and ``siblings`` of every row, and what it carries."""
    none = F.array().cast(SIBLINGS)
    top = manifest.groups.roots.select(
        "tree", F.lit(0).cast("long").alias("place"), none.alias("tail"), F.struct(F.col("digest").alias("root")).alias("above")
    )
    groups = _down(manifest.groups, top).select(
        F.col("item.key").alias("tree"),
        F.lit(0).cast("long").alias("place"),
        F.col("siblings").alias("tail"),
        F.struct(F.col("item.digest").alias("subroot"), F.col("above.root").alias("root")).alias("above"),
    )
    found = _down(manifest.rows, materialize(groups, "group_proofs"))
    return found.select(
        F.col("item.doc_id").alias("doc_id"),
        F.col("item.digest").alias("leaf"),
        "above.subroot",
        "above.root",
        "siblings",
        *[F.col(f"item.{name}").alias(name) for name in manifest.carried],
    )


def proof_digest(siblings: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(siblings, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def folded(digest: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(siblings, digest, lambda node, x: F.sha2(F.concat(x["before"], node, x["after"]), 256))
