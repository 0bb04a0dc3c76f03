"""Frames whose rows keep their order or their columns across a write."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tillcube.sources.shared import materialize

ROW = "row"
PART = "part"


def documents(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def embeddings(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """Every column of ``docs`` inside one struct ``row``, so that no name can clash with a column
    that an operator adds."""
    return docs.select(F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias(ROW))


def unpacked(rows: DataFrame, *added: Column) -> DataFrame:
    """The columns of ``row`` again, and ``added``. An added column replaces one of the same name."""
    names = {rows.select(column).columns[0].lower() for column in added}
    kept = [name for name in rows.schema[ROW].dataType.names if name.lower() not in names]
    return rows.select(*[F.col(f"{ROW}.`{name}`") for name in kept], *added)


def starts(parts: DataFrame, part: str, sums: Iterable[str]) -> DataFrame:
    """For each numbered part the sums over all parts before it, as ``<name>_before``.

    ``parts`` holds one row per written part with its totals: as many rows as tasks wrote, which is
    why one window without partitions may order them. Nothing of the size of the data goes through it.
    """
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        part, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).cast("long").alias(f"{name}_before") for name in sums]
    )


def running_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str], label: str) -> tuple[DataFrame, DataFrame]:
    """Sums over all rows that come earlier in an order, without ordering the table in one task.

    ``sums`` names long columns of ``df`` without nulls. Sampled splitters deal the rows out by range; each
    task sorts its range and adds up; the rows are written once with their part and its inner sums
    (so that both passes see the same parts); totals per part give each part what comes before it.

    Returns (``df`` with ``part`` and ``<name>_before`` for each sum, totals per part). Rows that tie keep
    the place that the write gave them.
    """
    for name in (PART, *(f"{name}_before" for name in sums)):
        if name in df.columns:
            raise ValueError(f"the frame already has a column {name}")
    fields = [StructField(PART, IntegerType()), *(StructField(f"{name}_inner", LongType()) for name in sums)]
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType([*df.schema.fields, *fields])
    written = materialize(ranges.mapInArrow(partial(_inner_sums, tuple(sums)), schema), label)
    totals = written.groupBy(PART).agg(*[F.sum(name).alias(name) for name in sums])
    # One row per task that wrote: bounded by the number of partitions, not by their rows.
    before = F.broadcast(starts(totals, PART, sums))
    placed = written.join(before, PART).select(
        *df.columns, PART, *[(F.col(f"{name}_inner") + F.col(f"{name}_before")).alias(f"{name}_before") for name in sums]
    )
    return placed, totals


def _inner_sums(sums: tuple[str, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    seen = dict.fromkeys(sums, 0)
    for batch in batches:
        added = [pa.array(np.full(batch.num_rows, part, np.int32))]
        for name in sums:
            values = np.asarray(batch.column(name)).astype(np.int64)
            ends = np.cumsum(values) + seen[name]
            added.append(pa.array(ends - values))
            seen[name] = int(ends[-1]) if len(ends) else seen[name]
        names = [*batch.schema.names, PART, *(f"{name}_inner" for name in sums)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], names)
