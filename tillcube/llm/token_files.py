"""Token ids in Parquet files that can be read selectively.

One row per document in ascending id order: its ids as a list column and its metadata beside it. Parquet
keeps the columns apart, so lengths and places are read without ids, and its page indexes (with small pages and
controlled row groups) let a reader of some documents skip the pages of the others. Ids are dictionary encoded
(few distinct ids in a row group take fewer bits than a number) and the ascending metadata columns delta encoded.

Defined cases: a null or empty text is the end id alone; a null id comes first; rows that share an id
follow each other in order of their text's checksum; extra columns are not written; an empty table gives empty files.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcube.llm.segments import encoder
from tillcube.llm.tables import PART, starts
from tillcube.llm.tokens import checksums, tokenizer_path, with_end

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
# Bytes of a row group and of a page of ids before compression.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def write_options(row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> dict[str, str]:
    return {
        "compression": "zstd",
        "parquet.compression.codec.zstd.level": "1",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        # Version 2 pages: delta encoding where there is no dictionary.
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": "true",
    }


def _encode(path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), 0
    known = encoder(path, leading_blank=False)
    for batch in batches:
        for documents, *encoded in known.steps(batch, "text"):
            ids, begin = with_end(*encoded, end_id)
            yield pa.RecordBatch.from_arrays(
                [
                    documents.column("doc_id"),
                    pa.array(np.full(documents.num_rows, part, np.int32)),
                    pa.array(seen + begin[:-1]),
                    pa.array(np.diff(begin)),
                    pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32))),
                ],
                names=[x.split()[0] for x in FILE_SCHEMA.split(", ")],
            )
            seen += int(begin[-1])


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
    options: dict[str, str] | None = None,
) -> None:
    """Write the ids of all documents under ``path``, in ascending id order within and across files. Texts move once."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].cast("string").alias("text"))
    rows = rows.withColumn("tie", F.crc32(F.col("text").cast("binary")))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    encoded = ordered.select("doc_id", "text").mapInArrow(
        partial(_encode, tokenizer_path(tokenizer), end_id), FILE_SCHEMA
    )
    encoded.write.options(**(options or write_options())).parquet(path)


def open_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``n_tokens``, without reading any ids."""
    return _placed(open_files(spark, path)).select("doc_id", "start", "n_tokens")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of some documents. The filter reaches the scan, which skips row groups and pages."""
    return open_files(spark, path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def _placed(files: DataFrame) -> DataFrame:
    totals = files.groupBy(PART).agg(F.sum("n_tokens").alias("tokens"))
    # One row per file: bounded by the number of partitions.
    before = F.broadcast(starts(totals, PART, ["tokens"]))
    return files.join(before, PART).withColumn("start", F.col("tokens_before") + F.col("part_start"))


CHECKED = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        ends = np.asarray(lists.offsets).astype(np.int64)
        sums = checksums(np.asarray(lists.values).astype("<u4"), ends)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends)), pa.array(sums)],
            names=[x.split()[0] for x in CHECKED.split(", ")],
        )


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` as the files hold them, counted from the ids."""
    placed = _placed(open_files(spark, path))
    return placed.select("doc_id", "start", "ids").mapInArrow(_check, CHECKED)
