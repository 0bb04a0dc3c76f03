"""Exact de-duplication by sorting content.

Texts are normalised (each run of blanks becomes one space). Sampled splitters deal them out by range of
(first characters, SHA-256, id) and every task sorts its range externally by (first characters, SHA-256,
whole text, id), so that equal texts lie side by side, the smallest id first; neighbours are compared in
full, byte by byte. The first characters and the digest keep the splitters small, however long the texts are;
the id in them cuts a group of any size over several tasks. A run of equal texts that touches
the edge of a task is joined with its continuation by its text, two runs per task at most.

Defined cases: null counts as the empty text; a row without id stays only if no equal text has an
id; of rows equal in text and id one stays; extra columns are kept as they are; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcube.llm.tables import ROW, packed, unpacked
from tillcube.llm.text import GAP, whole
from tillcube.sources.shared import materialize

# Characters of the text in a splitter.
HEAD = 32

MARKED = (
    "doc_id long, text_sha256 string, part int, run long, keep_id long, group_size long, first boolean, "
    "edge_text string, edge_rows long"
)


def normal(text: Column) -> Column:
    return F.regexp_replace(whole(text), GAP, " ")


def _ranges(rows: DataFrame) -> DataFrame:
    """Rows with ``norm`` and ``doc_id`` dealt out by range and sorted."""
    rows = rows.withColumns({"head": F.substring("norm", 1, HEAD), "text_sha256": F.sha2(F.col("norm").cast("binary"), 256)})
    by_id = F.col("doc_id").asc_nulls_last()
    return rows.repartitionByRange("head", "text_sha256", by_id).sortWithinPartitions(
        "head", "text_sha256", "norm", by_id
    )


def _new_texts(norm: pa.Array, last: str | None) -> np.ndarray:
    """True where a text differs from the one before it."""
    differs = np.ones(len(norm), bool)
    if len(norm):
        differs[0] = last is None or norm[0].as_py() != last
        differs[1:] = np.asarray(pc.not_equal(norm[1:], norm[:-1]))
    return differs


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with the row that stays of its run. Ids of the open run are held until it ends."""
    part = TaskContext.get().partitionId()
    held: list[tuple[pa.Array, pa.Array]] = []
    last, run = None, -1

    def closed(ids: pa.Array, digests: pa.Array, begins: np.ndarray, first_run: int, edge_text: str | None) -> pa.RecordBatch:
        """Whole runs, one after the other. ``edge_text``: the text of the only run, if it touches an edge."""
        lengths = np.diff(np.append(begins, len(ids)))
        first = np.zeros(len(ids), bool)
        first[begins] = True
        keep = ids.take(pa.array(np.repeat(begins, lengths)))
        size = pa.array(np.repeat(lengths, lengths))
        texts = [None] * len(ids) if edge_text is None else [edge_text] + [None] * (len(ids) - 1)
        return pa.RecordBatch.from_arrays(
            [
                ids, digests, pa.array(np.full(len(ids), part, np.int32)),
                pa.array(np.repeat(np.arange(first_run, first_run + len(begins)), lengths)),
                keep, size, pa.array(first), pa.array(texts, pa.string()),
                pa.array([None if x is None else len(ids) for x in texts], pa.int64()),
            ],
            names=[x.split()[0] for x in MARKED.split(", ")],
        )

    def held_run(at_edge: bool) -> pa.RecordBatch:
        ids = pa.concat_arrays([x for x, _ in held])
        digests = pa.concat_arrays([x for _, x in held])
        return closed(ids, digests, np.zeros(1, np.int64), run, last if at_edge else None)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, digests, norm = (batch.column(name) for name in ("doc_id", "text_sha256", "norm"))
        begins = np.flatnonzero(_new_texts(norm, last))
        if not len(begins):
            held.append((ids, digests))
            continue
        if begins[0]:
            held.append((ids[: begins[0]], digests[: begins[0]]))
        if held:
            yield held_run(run == 0)
            held.clear()
        tail = int(begins[-1])
        inner = begins[:-1]
        if len(inner) and run < 0:  # the task's first run ends in this batch
            to = int(inner[1]) if len(inner) > 1 else tail
            yield closed(ids[:to], digests[:to], np.zeros(1, np.int64), 0, norm[0].as_py())
            inner, run = inner[1:], 0
        if len(inner):
            head = int(inner[0])
            yield closed(ids[head:tail], digests[head:tail], inner - head, run + 1, None)
            run += len(inner)
        run += 1
        held.append((ids[tail:], digests[tail:]))
        last = norm[tail].as_py()
    if held:
        yield held_run(True)


def marks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), normal(docs[text_column]).alias("norm"))
    table = materialize(_ranges(rows).select("doc_id", "text_sha256", "norm").mapInArrow(_mark, MARKED), "exact_marks")
    edges = (
        table.where(F.col("edge_text").isNotNull())
        .groupBy("edge_text")
        .agg(
            F.min("doc_id").alias("all_keep"),
            F.sum("edge_rows").alias("all_size"),
            F.min(F.struct("part", "run")).alias("lead"),
            F.collect_list(F.struct("part", "run")).alias("places"),
        )
        .select("all_keep", "all_size", "lead", F.explode("places").alias("place"))
        .select("all_keep", "all_size", "lead", "place.part", "place.run")
    )
    leads = F.col("lead").isNull() | ((F.col("lead.part") == F.col("part")) & (F.col("lead.run") == F.col("run")))
    # At most two rows per task: bounded by the number of partitions.
    return table.join(F.broadcast(edges), ["part", "run"], "left").select(
        "doc_id",
        F.when(F.col("lead").isNull(), F.col("keep_id")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.coalesce("all_size", "group_size").alias("group_size"),
        (F.col("first") & leads).alias("kept"),
        "text_sha256",
    )


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of every run; the text too where the run is the task's first or last. One row waits
    until the next run begins."""
    part = TaskContext.get().partitionId()
    waiting: pa.RecordBatch | None = None
    last, number = None, 0

    def out(rows: pa.RecordBatch, first_run: int, texts: list[str | None]) -> pa.RecordBatch:
        count = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [rows.column(ROW), pa.array(np.full(count, part, np.int32)), pa.array(np.arange(first_run, first_run + count)),
             pa.array(texts, pa.string())],
            names=[ROW, "part", "run", "edge_text"],
        )

    for batch in batches:
        norm = batch.column("norm")
        begins = np.flatnonzero(_new_texts(norm, last))
        if not len(begins):
            continue
        if waiting is not None:
            yield out(waiting, number, [last if number == 0 else None])
            number += 1
        rows = batch.take(pa.array(begins[:-1]))
        if rows.num_rows:
            yield out(rows, number, [norm[0].as_py() if number == 0 else None] + [None] * (rows.num_rows - 1))
            number += rows.num_rows
        waiting = batch.take(pa.array(begins[-1:]))
        last = norm[int(begins[-1])].as_py()
    if waiting is not None:
        yield out(waiting, number, [last])


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    row = packed(docs)
    inner = row[ROW]
    rows = row.select(ROW, inner[id_column].cast("long").alias("doc_id"), normal(inner[text_column]).alias("norm"))
    schema = rows.select(ROW, F.lit(0).alias("part"), F.lit(0).cast("long").alias("run"), F.lit("").alias("edge_text")).schema
    for field in schema.fields:
        field.nullable = True
    table = materialize(_ranges(rows).select(ROW, "norm").mapInArrow(_firsts, schema), "exact_rows")
    begun = Window.partitionBy("edge_text").orderBy("part", "run")
    edges = table.where(F.col("edge_text").isNotNull()).select("part", "run", "edge_text")
    continued = edges.withColumn("nth", F.row_number().over(begun)).where("nth > 1").select("part", "run")
    # At most two rows per task: bounded by the number of partitions.
    return unpacked(table.join(F.broadcast(continued), ["part", "run"], "left_anti"))
