"""Token counts of whole texts; huge documents in overlapping chunks.

A document of more than ``chunk`` characters is cut, in one pass, into chunks that overlap and become rows of their own;
they are dealt out by text and place, so that one text is encoded by many tasks. Every chunk is encoded with offsets. Two neighbours are spliced at a
common boundary in their overlap: a character where in both a new word of the tokenizer's first split begins, well
before the end of the left chunk. That boundary is stable. The left chunk is right up to it, for a word ends where the
next character cannot go on with it, which the left chunk saw (and a special string that its end might cut begins
later); and the words from there on depend only on what follows, which the right chunk sees. By induction
from the first chunk, the counts between the splices are those of the whole text. Where an overlap has no such
boundary (a run of one kind of character may be longer than it), that document is cut again with an overlap
four times as wide, and with a chunk no shorter than twice the overlap, until all fit or one chunk holds it.

Defined cases: null counts as the empty text, with no tokens; rows that share an id are counted each;
extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcube.llm.segments import encoder
from tillcube.llm.text import whole
from tillcube.llm.tokens import tokenizer_path
from tillcube.sources.shared import materialize

TOKENIZER = "byte_bpe_50k.json"
CHUNK = 65_536
OVERLAP = 512
WIDEN = 4
# Chunks of a text that its cutting holds besides it.
CHUNKS_AT_ONCE = 16
# Characters before a chunk's end that its encoding may have wrong: the longest special string and one to look ahead.
MARGIN = 32

COUNTED = "doc_id long, row_key long, n_bytes long, n_tokens long"
CUT = "doc_id long, row_key long, n_bytes long, at long, last boolean, text string"
CHUNKED = (
    "doc_id long, row_key long, n_bytes long, at long, last boolean, n_tokens long, "
    "head_at array<long>, head_tokens array<long>, tail_at array<long>, tail_tokens array<long>"
)


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = encoder(path, leading_blank=True)
    for batch in batches:
        for documents, _, begin in known.steps(batch, "text"):
            kept = [documents.column(name) for name in ("doc_id", "row_key", "n_bytes")]
            counts_ = pa.array(np.diff(begin))
            yield pa.RecordBatch.from_arrays([*kept, counts_], [x.split()[0] for x in COUNTED.split(", ")])


def _boundaries(encoding) -> tuple[np.ndarray, np.ndarray]:
    """Characters where a word of the first split or a special string begins, and the tokens before each."""
    words = encoding.word_ids
    offsets = encoding.offsets
    # A special string has no word; it begins one, and so does what follows it.
    first = [i for i, word in enumerate(words) if word is None or i == 0 or word != words[i - 1]]
    return np.array([offsets[i][0] for i in first], np.int64), np.array(first, np.int64)


def _chunk(path: str, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokenizer = encoder(path, leading_blank=True).tokenizer
    names = [x.split()[0] for x in CHUNKED.split(", ")]
    for batch in batches:
        columns: list[list] = [[] for _ in range(5)]
        for text, at, last in zip(*(batch.column(x).to_pylist() for x in ("text", "at", "last")), strict=True):
            encoding = tokenizer.encode(text, add_special_tokens=False)
            places, tokens = _boundaries(encoding)
            head = places < overlap
            tail = (places >= len(text) - overlap) & (places < len(text) - MARGIN) & (not last)
            columns[0].append(len(encoding.ids))
            columns[1].append(places[head] + at)
            columns[2].append(tokens[head])
            columns[3].append(places[tail] + at)
            columns[4].append(tokens[tail])
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(x) for x in ("doc_id", "row_key", "n_bytes", "at", "last")),
                pa.array(columns[0], pa.int64()),
                *(pa.array(x, lists) for x in columns[1:]),
            ],
            names=names,
        )


def _cut(chunk: int, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of every text, a few at a time, in one pass over it."""
    step = chunk - overlap
    for batch in batches:
        for row in range(batch.num_rows):
            text = batch.column("text")[row].as_py()
            begins = range(0, max(len(text) - overlap - 1, 0) + 1, step)
            for first in range(0, len(begins), CHUNKS_AT_ONCE):
                some = begins[first : first + CHUNKS_AT_ONCE]
                same = [pa.array([batch.column(x)[row].as_py()] * len(some), pa.int64()) for x in ("doc_id", "row_key", "n_bytes")]
                own = [
                    pa.array(list(some), pa.int64()),
                    pa.array([at + chunk >= len(text) for at in some], pa.bool_()),
                    pa.array([text[at : at + chunk] for at in some], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*same, *own], [x.split()[0] for x in CUT.split(", ")])


def chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows of at most ``chunk`` characters from ``at`` on, each overlapping the next, dealt out one by one: those of one
    text are encoded by as many tasks as there are."""
    texts = docs.select("doc_id", "row_key", "n_bytes", "text")
    # A stated number of partitions, for adaptive execution would join them by their bytes, which say little of the work.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.mapInArrow(partial(_cut, chunk, overlap), CUT).repartition(tasks, "row_key", "at")


def splice(encoded: DataFrame) -> DataFrame:
    """Counts of documents from their chunks; null where two neighbours have no common boundary."""
    following = Window.partitionBy("row_key").orderBy("at")
    pairs = encoded.withColumns(
        {"next_at": F.lead("head_at").over(following), "next_tokens": F.lead("head_tokens").over(following)}
    )
    common = F.array_max(F.array_intersect("tail_at", "next_at"))
    spliced = pairs.withColumn("splice", common).select(
        "doc_id", "row_key", "n_bytes", "last", "n_tokens", "splice",
        F.get("tail_tokens", F.array_position("tail_at", F.col("splice")).cast("int") - 1).alias("kept"),
        F.get("next_tokens", F.array_position("next_at", F.col("splice")).cast("int") - 1).alias("left_out"),
    )
    # A chunk counts up to its splice; the tokens that its right neighbour has before the splice do not count.
    tokens = F.when(F.col("last"), F.col("n_tokens")).otherwise(F.col("kept") - F.col("left_out"))
    return spliced.groupBy("doc_id", "row_key", "n_bytes").agg(
        F.when(F.count_if(~F.col("last") & F.col("splice").isNull()) == 0, F.sum(tokens)).alias("n_tokens")
    )


def counts(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row."""
    if not MARGIN < overlap < chunk:
        raise ValueError(f"the overlap must be over {MARGIN} characters and shorter than a chunk")
    path = tokenizer_path(tokenizer)
    text = whole(docs[text_column])
    rows = docs.select(
        docs[id_column].cast("long").alias("doc_id"),
        text.alias("text"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.lit(None).cast("long").alias("row_key"),
    )
    counted = [rows.where(F.length("text") <= chunk).mapInArrow(partial(_count, path), COUNTED)]
    # A key for each huge row, kept with it, for ids may repeat.
    huge = materialize(
        rows.where(F.length("text") > chunk).withColumn("row_key", F.monotonically_increasing_id()), "huge_texts"
    )
    while not huge.isEmpty():
        encoded = chunks(huge, chunk, overlap).mapInArrow(partial(_chunk, path, overlap), CHUNKED)
        tried = materialize(splice(encoded), "huge_counts")
        counted.append(tried.where(F.col("n_tokens").isNotNull()))
        overlap *= WIDEN
        chunk = max(chunk, 2 * overlap)
        failed = tried.where(F.col("n_tokens").isNull()).select("row_key")
        huge = materialize(huge.join(failed, "row_key", "left_semi"), "huge_texts")
    result = counted[0]
    for more in counted[1:]:
        result = result.unionByName(more)
    return result.select("doc_id", "n_bytes", "n_tokens")
