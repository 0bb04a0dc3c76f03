"""Best-fit packing of documents into sequences of fixed capacity.

A document is its token ids and an end id; only one longer than the capacity is cut, into pieces of
full capacity of which the first may be shorter. Pieces are range-sorted by length, longest first, and so
have a global rank. Gaps (the free room of begun sequences) are kept sorted by size. Each superstep takes the
pieces of the next length and sweeps the gaps: a piece goes to the successor of its length, the smallest
gap that holds it; where several want one gap their rank decides; the gaps that took pieces
shrink and are sorted in again; what finds no gap begins new sequences.

Pieces of one length differ in nothing but their rank, and gaps of one size in nothing but their
sequence's number, so a superstep moves runs of equals: intervals of ranks into intervals of sequences. There are at
most as many lengths as tokens in a sequence and a superstep splits two runs at most, so the table of runs is bounded
by the capacity, whatever the number of documents. Histogram, ranks and the placing of every piece are Spark jobs.

Defined cases: a null or empty text is its end id alone; ties go by id and piece; rows that share an id are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.llm.segments import encoder
from tillcube.llm.tables import running_sums
from tillcube.llm.tokens import checksums, tokenizer_path, with_end
from tillcube.sources.shared import materialize

CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


class Placement(NamedTuple):
    """Pieces of one length with ranks ``rank`` to ``rank + count - 1``: ``each`` of them per sequence, from
    ``sequence`` on, the first of a sequence at ``offset``."""

    length: int
    rank: int
    count: int
    sequence: int
    each: int
    offset: int


def cuts(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces of a document."""
    head = length % capacity
    if head:
        yield 0, head
    for start in range(head, length, capacity):
        yield start, capacity


def _pieces(path: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = encoder(path, leading_blank=True)
    for batch in batches:
        for documents, *encoded in known.steps(batch, "text"):
            ids, begin = with_end(*encoded, end_id)
            rows, numbers, starts, lengths = [], [], [], []
            for row, length in enumerate(np.diff(begin).tolist()):
                for piece, (start, size) in enumerate(cuts(length, capacity)):
                    rows.append(row)
                    numbers.append(piece)
                    starts.append(start)
                    lengths.append(size)
            ends = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays(
                [
                    documents.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(checksums(ids, ends)),
                ],
                names=[x.split()[0] for x in PIECES.split(", ")],
            )


def pieces(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of every document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return rows.mapInArrow(partial(_pieces, tokenizer_path(tokenizer), end_id, capacity), PIECES)


def sweep(histogram: dict[int, int], capacity: int) -> list[Placement]:
    """Place pieces, given how many there are of each length, longest first, into the smallest gap that holds them."""
    sizes: list[int] = []  # of gaps, ascending
    gaps: dict[int, list[tuple[int, int]]] = {}  # size to runs of (first sequence, sequences)
    placed: list[Placement] = []
    opened = 0

    def put(size: int, first: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                insort(sizes, size)
                gaps[size] = []
            gaps[size].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            each = gap // length
            taken = min(left, each * count)
            full, rest = divmod(taken, each)
            placed.append(Placement(length, rank, taken, first, each, capacity - gap))
            put(gap - each * length, first, full)
            if rest:
                put(gap - rest * length, first + full, 1)
            put(gap, first + full + bool(rest), count - full - bool(rest))
            left, rank = left - taken, rank + taken
    return placed


def _place(plan: list[Placement], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.array(sorted(plan), np.int64).reshape(-1, len(Placement._fields))
    lengths, ranks, _, firsts, each, offsets = table.T
    for batch in batches:
        length, rank = (np.asarray(batch.column(name)) for name in ("length", "rank"))
        # Longest first in the ranks, shortest first in the table; both ascend within a length.
        lo, hi = np.searchsorted(lengths, length), np.searchsorted(lengths, length, "right")
        while (open_ := hi - lo > 1).any():
            middle = (lo + hi) // 2
            right = open_ & (ranks[np.minimum(middle, len(ranks) - 1)] <= rank)
            lo, hi = np.where(right, middle, lo), np.where(open_ & ~right, middle, hi)
        nth = rank - ranks[lo]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(x.split()[0]) for x in PIECES.split(", ")),
                pa.array(firsts[lo] + nth // each[lo]),
                pa.array(offsets[lo] + nth % each[lo] * length),
            ],
            names=[x.split()[0] for x in PLACED.split(", ")],
        )


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of ``pieces``, which are written first, for ranking them reads
    them twice and no text should be encoded twice."""
    cut = materialize(cut, "pieces_cut")
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked, _ = running_sums(cut.withColumn("one", F.lit(1).cast("long")), order, ["one"], "pieces")
    found = ranked.groupBy("length").agg(F.count("*").alias("pieces"), F.min("one_before").alias("first")).collect()
    histogram = {row["length"]: row["pieces"] for row in found}
    plan = sweep(histogram, capacity)
    # One entry per length: bounded by the capacity.
    firsts = F.broadcast(ranked.groupBy("length").agg(F.min("one_before").alias("first")))
    rows = ranked.join(firsts, "length").withColumn("rank", F.col("one_before") - F.col("first"))
    names = [x.split()[0] for x in PIECES.split(", ")]
    return rows.select(*names, "rank").mapInArrow(partial(_place, plan), PLACED)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its pieces in order and the tokens it holds. A sequence has at most as many
    pieces as tokens."""
    member = F.struct("offset", "doc_id", "piece", "start", "length")
    return packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(member)).alias("members"), F.sum("length").alias("tokens")
    )
