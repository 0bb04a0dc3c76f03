"""Near-duplicates by SimHash fingerprints, searched in BK-trees.

The fingerprint of a text has a bit set where more than half of the hashes of its word shingles have it set.
Texts whose fingerprints differ in few bits are linked, and links join into components.

The search is sharded so that every tree has a proven size bound. The 64 bits are cut into blocks. Two fingerprints that
differ in at most ``radius`` bits differ in at most ``radius`` blocks, so for some choice of ``radius`` blocks they
agree in all the others: for each choice, fingerprints that agree in the other blocks form one shard, with its own BK-tree,
and only they search it. A shard holds at most 2^(bits in the chosen blocks) distinct fingerprints (65,536 with eight blocks and
radius 2), whatever the number of documents and however similar they are. All trees together grow with the corpus,
so none is sent to every task: each goes to the one task where its queries are.

A tree reports for each member the lowest member that it is joined to, not all pairs; equal fingerprints are
one node from the start.

Defined cases: a null, empty or blank text has fingerprint zero and is linked like any other; a text of
fewer words than a shingle is one shingle; rows that share an id and a text are kept or dropped together, as are rows
without an id; ties and repeated rows change nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.llm.bk_forest import Forest, lowest_linked
from tillcube.llm.components import stars
from tillcube.llm.tables import ROW, packed, unpacked
from tillcube.sources.shared import materialize

SHINGLE = 3
RADIUS = 2
BLOCKS = 8
BITS = 64
SEED = 42
# Hashes whose bits are counted in one step.
STEP_HASHES = 100_000


def shingle_hashes(text: bytes, shingle: int) -> list[int]:
    """XXH64 of every shingle of words, repeats included; none without words."""
    words = text.lower().split()
    if not words:
        return []
    line = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    begins = [0, *ends]
    digest = xxhash.xxh64_intdigest
    last = ends[min(shingle, len(words)) - 1 :]
    return [digest(line[a : b - 1], SEED) for a, b in zip(begins, last, strict=False)]


def majority(hashes: list[int], counts: list[int]) -> np.ndarray:
    """For each run of hashes the number whose bits are set in over half of it; zero for an empty run."""
    prints = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        sizes = np.array(counts)[some]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = np.r_[0, np.cumsum(sizes)[:-1]]
        set_ = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
        packed_bits = np.packbits(2 * set_ > sizes[:, None], axis=1, bitorder="little")
        prints[some] = packed_bits.view("<u8").ravel()
    return prints


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, hashes, counts = [], [], []
        for text in batch.column("text").cast(pa.binary()):
            found = shingle_hashes(text.as_py() or b"", shingle)
            hashes += found
            counts.append(len(found))
            if len(hashes) > STEP_HASHES:
                prints.append(majority(hashes, counts))
                hashes, counts = [], []
        prints.append(majority(hashes, counts))
        out = np.concatenate(prints).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "print"])


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``print`` (64 bits as a signed number) of every row."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle), "doc_id long, print long")


def _masks(radius: int, blocks: int) -> list[int]:
    """Signed masks that leave out each choice of ``radius`` blocks."""
    bounds = [BITS * at // blocks for at in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    left = [((1 << BITS) - 1) & ~sum(chosen) for chosen in combinations(block, radius)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in left]


def _search(radius: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside the shards of a task; the shard at the end of a batch waits for the next."""
    rest = None

    def linked(table: pa.Table) -> pa.RecordBatch:
        choice, shard, prints = (np.asarray(table.column(name)) for name in ("choice", "shard", "print"))
        tree = np.cumsum(np.r_[False, (choice[1:] != choice[:-1]) | (shard[1:] != shard[:-1])])
        shared = np.bincount(tree)[tree] > 1
        prints, tree = prints[shared], tree[shared]
        forest = Forest(prints.view(np.uint64), tree)
        low = lowest_linked(len(prints), list(forest.within(radius)))
        joined = low != np.arange(len(prints))
        ends = prints[joined], prints[low[joined]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(*ends)), pa.array(np.minimum(*ends))], ["node", "other"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        choice, shard = (np.asarray(table.column(name)) for name in ("choice", "shard"))
        begins = np.flatnonzero((choice[1:] != choice[:-1]) | (shard[1:] != shard[:-1])) + 1
        cut = int(begins[-1]) if len(begins) else 0
        rest = table.slice(cut)
        if cut:
            yield linked(table.slice(0, cut))
    if rest is not None and rest.num_rows:
        yield linked(rest)


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links (``node`` > ``other``) that join all fingerprints of the distinct ``print`` within ``radius`` bits."""
    if not radius < blocks:
        raise ValueError("there must be more blocks than bits in the radius")
    shards = [
        F.struct(F.lit(choice).cast("short").alias("choice"), F.col("print").bitwiseAND(F.lit(mask)).alias("shard"))
        for choice, mask in enumerate(_masks(radius, blocks))
    ]
    dealt = prints.select("print", F.explode(F.array(*shards)).alias("at")).select("at.choice", "at.shard", "print")
    together = dealt.repartition("choice", "shard").sortWithinPartitions("choice", "shard", "print")
    return together.mapInArrow(partial(_search, radius), "node long, other long")


def components(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Add ``component_id``, the smallest ``doc_id`` reachable, to rows of ``doc_id`` and ``print``."""
    distinct = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("lowest")), "prints")
    roots = stars(links(distinct.select("print"), radius, blocks)).withColumnRenamed("node", "print")
    rooted = distinct.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    found = rooted.select("print", "root").join(lowest, "root").select("print", "component_id")
    return prints.join(found, "print")


def hexadecimal(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), BITS // 4, "0"))


def groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id`` of every row."""
    prints = materialize(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    found = components(prints, radius, blocks)
    return found.select("doc_id", hexadecimal(F.col("print")).alias("fingerprint"), "component_id")


def deduplicate(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with their columns. Rows without an id
    stay only where their whole component has none."""
    prints = materialize(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    found = components(prints, radius, blocks)
    dropped = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id")).distinct()
    row = packed(docs)
    own = row[ROW][id_column].cast("long")
    return unpacked(row.join(dropped, own.eqNullSafe(dropped["id"]), "left_anti"))
