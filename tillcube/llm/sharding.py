"""Shards of nearly equal size in bytes.

Documents are ordered by id; a document's place on the line of all bytes is the sum of the sizes before
it, from totals per partition and sums inside each. The line is cut at equal targets: a document goes to
the shard that holds its middle, so shards are contiguous in the order and their sizes differ from the
target by at most one document.

Defined cases: a null text has no bytes but takes one for its end; a null id comes first; rows with one
id follow each other by size and checksum, and equal rows get slots of their own; a document longer
than a target leaves shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.llm.tables import ROW, packed, running_sums, unpacked
from tillcube.llm.text import whole

SHARDS = 8
END_BYTES = 1


def place(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in each) to rows with ``doc_id``, ``size``
    and ``text_crc32``."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    placed, totals = running_sums(rows.withColumn("one", F.lit(1).cast("long")), order, ["size", "one"], "shards")
    total = totals.agg(F.sum("size")).first()[0] or 1
    middle = F.expr(f"(2 * size_before + size) * {shards}L div {2 * total}L").cast("int")
    placed = placed.withColumn("shard", F.least(middle, F.lit(shards - 1)))
    first = placed.groupBy("shard").agg(F.min("one_before").alias("first"))
    # One row per shard.
    return (
        placed.join(F.broadcast(first), "shard")
        .withColumn("slot", F.col("one_before") - F.col("first"))
        .drop("one", "one_before", "size_before", "first", "part")
    )


def sizes(docs: DataFrame, id_column: str, text_column: str) -> list:
    text = whole(docs[text_column])
    return [
        docs[id_column].cast("long").alias("doc_id"),
        (F.octet_length(text) + END_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ]


def assignments(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of every document. Texts stay where they are."""
    return place(docs.select(*sizes(docs, id_column, text_column)), shards)


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Write all columns of ``docs`` with ``shard`` and ``slot`` as Parquet, one folder per shard. Each task
    holds one range of the order and so writes to one shard or a few."""
    row = packed(docs)
    inner = row[ROW]
    text = whole(inner[text_column])
    rows = row.select(
        ROW,
        inner[id_column].cast("long").alias("doc_id"),
        (F.octet_length(text) + END_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = place(rows, shards)
    unpacked(placed, F.col("shard"), F.col("slot")).write.partitionBy("shard").parquet(path)
