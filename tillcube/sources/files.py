"""File scans: one file, one directory per part, reader chosen by suffix."""

from __future__ import annotations

from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed value: the encoding of the retail files.
RETAIL_ENCODING = "ISO-8859-1"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """Scan CSV files with a header row.

    Without ``schema`` every column is text under its header name and only the header is read
    ahead; typing is a later projection. A file whose header differs from the schema is an error
    rather than a mix-up of columns. ``multi_line`` allows line breaks inside quotes but stops
    Spark from splitting a file, so it is off unless a source needs it.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", recursive)
        .option("enforceSchema", False)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_retail_file(spark: SparkSession, path: str) -> DataFrame:
    """Scan one retail file (or directory) with the reader its suffix asks for.

    Adds the file's name as ``source_file``. A workbook has no Spark reader: export its sheets and
    use :func:`read_parts`.
    """
    name = PurePosixPath(path.rstrip("/")).name
    suffix = PurePosixPath(name).suffix.lower()
    if suffix == ".csv":
        lines = read_csv(spark, path, encoding=RETAIL_ENCODING)
    elif suffix == ".parquet":
        lines = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported file format: {name}")
    return lines.withColumn("source_file", F.lit(name))


def read_parts(
    spark: SparkSession, folder: str, part_column: str = "source_sheet", encoding: str = RETAIL_ENCODING
) -> DataFrame:
    """Scan a folder holding one directory of CSV files per part (the sheets of a workbook).

    All parts are stacked in one scan and the directory's name is kept in ``part_column``.
    """
    lines = read_csv(spark, folder, encoding=encoding, recursive=True)
    part = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return lines.select("*", F.url_decode(part).alias(part_column))


def part_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the part directories of a folder, from the listing of its files."""
    listed = read_csv(spark, folder, recursive=True).inputFiles()
    return sorted({unquote(PurePosixPath(path).parent.name) for path in listed})
