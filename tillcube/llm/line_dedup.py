"""De-duplication of repeated passages by content-defined chunks of lines.

A rolling hash over the hashes of the last lines ends a chunk wherever its low bits are zero and the chunk has two lines. A
boundary thus depends on a few lines only, so a passage that stands at another place in another document is cut at the
same lines, but for its first and last ones. A line of many words is always a chunk of its own; a shorter line is alone
in a chunk only where it has no other short line beside it.

Whole chunks that stand in several places are anchors. At the edges of a passage a chunk has lines of its surroundings too,
so the ends of chunks (up to the first ``PASSAGE_WORDS`` words from a boundary) are compared as well, and the shortest runs of
lines that reach as many words: matches grow line by line to both sides, and a passage in which no boundary, or one that
depends on the line before it, falls is still found. Of the lines that match, runs go that hold an anchor or have ``PASSAGE_WORDS`` words or more; the first
copy stays: the one in the document with the smallest id, the first in it.

Lines are compared by their bytes: they are grouped by digest and text, which collapses copies before they move, so that a
line that stands in a third of all documents is a row per task. Only lines that occur again are looked at further, and a
piece of several is compared as the list of their digests. Should two texts ever share a digest, lines with that digest
count as occurring once.

Defined cases: a null or empty text has no lines and stays as it is; blank lines count as lines, but a run without a word
is never removed; pieces of rows without id are removed only if some row with an id has them; rows that share an id and a
text are cut alike, and rows that share an id but not the text both keep what only they have; extra columns stay, but for
those named ``n_lines`` and ``removed``, which are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.llm.tables import ROW, packed, unpacked
from tillcube.sources.shared import materialize

# Lines that a boundary depends on, and lines between boundaries on average before chunks of one line are joined on.
WINDOW = 2
AVERAGE = 2
# Words of a passage.
PASSAGE_WORDS = 50
BASE = np.uint64(0x9E3779B97F4A7C15)

LINES = "digest binary, line string, times long"
PLACES = "doc_id long, text_key long, line_no int, digest binary, words int, begins boolean, ends boolean"
PIECES = (
    "doc_id long, text_key long, first_line int, n_lines int, words_before long, words_after long, anchor boolean, "
    "again boolean, piece binary"
)
SPAN = "struct<first_line:int,n_lines:int,kept_in:bigint>"
REMOVED = f"doc_id long, text_key long, removed array<{SPAN}>"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def chunk_ends(lines: list[bytes], window: int, average: int, passage_words: int) -> np.ndarray:
    """Numbers of the lines after which a chunk ends."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(line) for line in lines), np.uint64, len(lines))
    rolled = np.zeros(len(lines), np.uint64)
    for back in range(window):
        rolled[back:] = rolled[back:] * BASE + hashes[: len(lines) - back]
    # High bits of a product depend on all bits of the hash.
    ends = ((rolled * BASE) >> np.uint64(33)) % np.uint64(average) == 0
    long = np.fromiter((len(line.split()) >= passage_words for line in lines), bool, len(lines))
    ends |= long
    ends[:-1] |= long[1:]
    ends[-1] = True
    found: list[int] = []
    first = 0
    for end in np.flatnonzero(ends).tolist():
        if end == first and not long[end]:
            # A short line alone goes with the lines after it, or where none may with those before.
            if end + 1 < len(lines) and not long[end + 1]:
                continue
            if found and not long[found[-1]]:
                found.pop()
        found.append(end)
        first = end + 1
    return np.array(found)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct lines of each batch, and how often they stand in it."""
    for batch in batches:
        times: dict[str, int] = {}
        for text in batch.column("text").to_pylist():
            for line in (text or "").split("\n") if text else ():
                times[line] = times.get(line, 0) + 1
        digests = [xxhash.xxh3_128_digest(line.encode()) for line in times]
        columns = [pa.array(digests, pa.binary()), pa.array(list(times), pa.string()), pa.array(list(times.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, _names(LINES))


def _places(
    window: int, average: int, passage_words: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Every line of every text, and whether a chunk begins or ends with it."""
    types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.bool_(), pa.bool_())
    for batch in batches:
        columns: list[list] = [[] for _ in types]
        for doc_id, key, text in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "text_key", "text")), strict=True):
            if not text:
                continue
            lines = text.encode().split(b"\n")
            ends = np.zeros(len(lines), bool)
            ends[chunk_ends(lines, window, average, passage_words)] = True
            values = (
                [doc_id] * len(lines), [key] * len(lines), range(len(lines)), map(xxhash.xxh3_128_digest, lines),
                (len(line.split()) for line in lines), np.r_[True, ends[:-1]].tolist(), ends.tolist(),
            )
            for column, value in zip(columns, values, strict=True):
                column.extend(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], _names(PLACES))


def pieces_of(words: list[int], begins: list[bool], ends: list[bool], passage_words: int) -> dict[tuple[int, int], bool]:
    """Pieces (first and last line) of lines side by side that occur again, and whether they are whole chunks.

    Ends of chunks are taken up to the first ``passage_words`` words from the boundary, and shortest runs from and to
    lines with words only, so that a line is in a bounded number of pieces besides its chunk.
    """
    found: dict[tuple[int, int], bool] = {}
    first = 0
    for last in range(len(words)):
        if not ends[last] and last + 1 < len(words):
            continue
        total = sum(words[first : last + 1])
        if begins[first] and ends[last] and total and (last > first or total >= passage_words):
            found[first, last] = True
        spoken = [at for at in range(first, last + 1) if words[at]]
        if begins[first]:
            _grow(found, first, spoken, words, passage_words, True)
        if ends[last]:
            _grow(found, last, spoken[::-1], words, passage_words, False)
        first = last + 1
    # The shortest run that reaches the words, from each line and to each line.
    spoken = [at for at, count in enumerate(words) if count]
    for order in (spoken, spoken[::-1]):
        reach, count = 0, 0
        for line in order:
            while reach < len(order) and count < passage_words:
                count += words[order[reach]]
                reach += 1
            if count < passage_words:
                break
            other = order[reach - 1]
            found.setdefault((min(line, other), max(line, other)), False)
            count -= words[line]
    return found


def _grow(
    found: dict[tuple[int, int], bool], bound: int, spoken: list[int], words: list[int], passage_words: int, forwards: bool
) -> None:
    count = 0
    for line in spoken:
        count += words[line]
        found.setdefault((bound, line) if forwards else (line, bound), False)
        if count >= passage_words:
            return


def _pieces(passage_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the repeated lines of each document. ``again``: the document has it before, all of it."""
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
    for batch in batches:
        columns: list[list] = [[] for _ in types]
        for doc_id, key, lines in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "text_key", "lines")), strict=True):
            seen: dict[bytes, int] = {}
            before = 0
            at = 0
            while at < len(lines):
                to = at + 1
                while to < len(lines) and lines[to]["line_no"] == lines[to - 1]["line_no"] + 1:
                    to += 1
                run = lines[at:to]
                words = [x["words"] for x in run]
                sums = [before]
                for count in words:
                    sums.append(sums[-1] + count)
                pieces = pieces_of(words, [x["begins"] for x in run], [x["ends"] for x in run], passage_words)
                for (first, last), anchor in sorted(pieces.items()):
                    piece = b"".join(x["digest"] for x in run[first : last + 1])
                    start = run[first]["line_no"]
                    again = seen.setdefault(piece, start + last - first) < start
                    row = (doc_id, key, start, last - first + 1, sums[first], sums[last + 1], anchor, again, piece)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                at, before = to, sums[-1]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], _names(PIECES))


def _spans(passage_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of lines that go, from the pieces of each document that stand elsewhere before."""
    kind = pa.list_(pa.struct([("first_line", pa.int32()), ("n_lines", pa.int32()), ("kept_in", pa.int64())]))
    for batch in batches:
        removed = []
        for pieces in batch.column("gone").to_pylist():
            runs: list[dict] = []
            for piece in sorted(pieces, key=lambda x: x["first_line"]):
                end = piece["first_line"] + piece["n_lines"]
                if runs and piece["first_line"] <= runs[-1]["end"]:
                    run = runs[-1]
                    run["end"], run["after"] = max(run["end"], end), max(run["after"], piece["words_after"])
                    run["anchor"], run["kept_in"] = run["anchor"] or piece["anchor"], min(run["kept_in"], piece["kept_in"])
                else:
                    own = {"first": piece["first_line"], "end": end, "before": piece["words_before"]}
                    runs.append({**own, "after": piece["words_after"], **{x: piece[x] for x in ("anchor", "kept_in")}})
            gone = [run for run in runs if run["anchor"] or run["after"] - run["before"] >= passage_words]
            removed.append([(run["first"], run["end"] - run["first"], run["kept_in"]) for run in gone])
        rows = [[dict(zip(("first_line", "n_lines", "kept_in"), x, strict=True)) for x in spans] for spans in removed]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(rows, kind)], _names(REMOVED)[:3])


def removals(
    docs: DataFrame, window: int = WINDOW, average: int = AVERAGE, passage_words: int = PASSAGE_WORDS
) -> DataFrame:
    """``doc_id``, ``text_key`` and ``removed``, a list of (first line, lines, id of the document that keeps it), for
    rows of ``doc_id``, ``text_key`` and ``text``."""
    # By bytes; a line of many documents is summed up where it is read.
    equal = docs.select("text").mapInArrow(_lines, LINES).groupBy("digest", "line").agg(F.sum("times").alias("times"))
    again = equal.groupBy("digest").agg(F.count("*").alias("texts"), F.sum("times").alias("times"))
    again = materialize(again.where("texts = 1 and times > 1").select("digest"), "repeated_lines")
    places = docs.mapInArrow(partial(_places, window, average, passage_words), PLACES)
    line = F.struct("line_no", "digest", "words", "begins", "ends")
    # A document's own lines.
    own = places.join(again, "digest", "left_semi").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(line)).alias("lines"))
    pieces = materialize(own.mapInArrow(partial(_pieces, passage_words), PIECES), "line_pieces")
    kept = pieces.groupBy("piece").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("places")).where("places > 1")
    # Written, so that a piece that many documents have may be dealt to several tasks, or met where it lies.
    found = pieces.join(materialize(kept.select("piece", "keeper"), "kept_pieces"), "piece")
    first = F.col("keeper").eqNullSafe(F.col("doc_id")) | F.col("keeper").isNull()
    gone = found.where(F.col("again") | ~first)
    columns = ("first_line", "n_lines", "words_before", "words_after", "anchor")
    piece = F.struct(*columns, F.coalesce("keeper", "doc_id", F.lit(-1)).cast("long").alias("kept_in"))
    listed = gone.groupBy("doc_id", "text_key").agg(F.collect_set(piece).alias("gone"))
    return listed.mapInArrow(partial(_spans, passage_words), REMOVED).where(F.size("removed") > 0)


def deduplicate(
    docs: DataFrame,
    window: int = WINDOW,
    average: int = AVERAGE,
    passage_words: int = PASSAGE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with the cleaned text in place of the text, ``n_lines`` (before) and ``removed``."""
    row = packed(docs)
    inner = row[ROW]
    text = inner[text_column].cast("string")
    keyed = row.select(
        ROW, inner[id_column].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )
    gone = removals(keyed.select("doc_id", "text_key", "text"), window, average, passage_words)
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "removed")
    same = keyed["doc_id"].eqNullSafe(gone["gone_id"]) & (keyed["text_key"] == gone["gone_key"])
    joined = keyed.join(gone, same, "left")
    lines = F.split("text", "\n")
    cleaned = F.array_join(
        F.filter(
            lines,
            lambda _, at: ~F.exists(
                "removed", lambda span: (at >= span["first_line"]) & (at < span["first_line"] + span["n_lines"])
            ),
        ),
        "\n",
    )
    none = F.array().cast(gone.schema["removed"].dataType)
    return unpacked(
        joined,
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(cleaned).alias(text_column),
        F.when(F.length("text") > 0, F.size(lines)).otherwise(0).cast("long").alias("n_lines"),
        F.coalesce("removed", none).alias("removed"),
    )
