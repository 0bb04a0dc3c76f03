"""Table sinks: CSV, a set of warehouse tables, bounded samples, replication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Write CSV with a header, doubled quotes and untrimmed text."""
    (
        df.write.option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_warehouse(
    tables: Mapping[str, DataFrame],
    folder: str,
    partitions: Mapping[str, Sequence[str]] | None = None,
    within: Mapping[str, Sequence[str]] | None = None,
    derived: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> None:
    """Write every table of a warehouse as Parquet below ``folder``.

    A table named in ``partitions`` is laid out by those columns. Its rows are spread by the
    partition columns first, through the rebalance hint, which also splits an oversized member:
    few files per directory, and no task that holds one whole month. Its rows are
    sorted by the partition columns in any case; ``within`` names columns that they follow next, such as the day, so
    that like values lie together in a file and take less space. ``derived`` adds to a table columns that follow from its
    others, after its rows have been spread.
    """
    for name, table in tables.items():
        columns = list((partitions or {}).get(name, ()))
        inside = list((within or {}).get(name, ()))
        table = table.hint("rebalance", *columns) if columns else table
        table = table.sortWithinPartitions(*columns, *inside) if inside else table
        table = (derived or {}).get(name, lambda whole: whole)(table)
        writer = table.write.partitionBy(*columns) if columns else table.write
        writer.parquet(f"{folder}/{name}")


def read_warehouse(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Scan tables written by :func:`write_warehouse`."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def first_rows(df: DataFrame, count: int = 1000, order_by: Sequence[str] | None = None) -> DataFrame:
    """Return the first ``count`` rows in the order of the given columns (all columns by default)."""
    ordering = [F.col(name).asc_nulls_last() for name in (order_by or df.columns)]
    return df.orderBy(*ordering).limit(count)


def replicate(df: DataFrame, times: int) -> DataFrame:
    """Stack a table ``times`` times. Each row is repeated where it lies; nothing is shuffled."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(times)))
    return df.select("*", copies.alias("_copy")).drop("_copy") if times > 0 else df.limit(0)
