"""Dense row numbers without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcube.sources.shared import materialize

# monotonically_increasing_id holds the partition above these bits and the position below them.
POSITION_BITS = 33


# Copies of a row that one generated array holds.
RUN = 4_096
# Tasks that copies of one row are dealt out to at most.
TIES = 1_024


def number_rows(
    df: DataFrame,
    name: str,
    order_by: Sequence[str] | None = None,
    repeated: bool = False,
    tie: str | None = None,
) -> DataFrame:
    """Put a column ``name`` with 1..n in front.

    With ``order_by`` the numbers follow that order, as a row number over the whole table would.
    Spark's range partitioning does the sort. Rows may tie if ``repeated`` says so: equal rows are then counted, and only
    distinct rows are dealt out and sorted (by ``order_by``, then by the other columns), so that a row with any number of
    copies is one row until the copies get their numbers, one after the other. The numbers depend on the rows alone:
    a second run, or a task that runs again, gives every row the same ones.

    Counting moves every row once more, which is lost where few rows have copies. A column ``tie`` that varies among equal
    rows (:func:`with_tie`) saves it: rows are then sorted by it too, last, so that copies of a row are dealt out as well.
    It is not in the result, and as equal rows do not differ without it, neither are the numbers changed by it.

    Without an order the numbers follow the partitions as they are read and nothing is shuffled,
    which is what a fact table needs: its row id has to be dense and unique, nothing more.

    The rows are written once with their position in their partition, so that both passes see the
    same partitions; the second adds each partition's offset, which is one row per written
    partition and therefore small enough to broadcast.
    """
    columns = [column for column in df.columns if column != tie]
    ordering = list(order_by or [])
    if ordering and repeated:
        df = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
        ordering += [column for column in columns if column not in ordering]
    if ordering and tie:
        ordering += [column for column in [*columns, tie] if column not in ordering]
    if ordering:
        df = df.orderBy(*[F.col(column).asc_nulls_last() for column in ordering])
    if ordering and repeated:
        df = expanded(df, columns)
    staged = materialize(df.select(*columns, F.monotonically_increasing_id().alias("_at")), name)
    partition = F.shiftright("_at", POSITION_BITS)
    position = F.col("_at") - F.shiftleft(partition, POSITION_BITS)
    sizes = staged.groupBy(partition.alias("_partition")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_partition", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    return (
        staged.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .select((F.col("_offset") + position + 1).alias(name), *columns)
    )


def with_tie(written: DataFrame, name: str) -> DataFrame:
    """A small number that varies along a table just read from files, so that a task that runs again gives it again."""
    return written.withColumn(name, (F.monotonically_increasing_id() % TIES).cast("smallint"))


def expanded(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row as often as ``_copies`` says, where it lies. Runs of copies come first, so that no array is long."""
    runs = F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("_copies") - 1).cast("bigint"), F.lit(RUN).cast("bigint")))
    left = F.least(F.col("_copies") - F.col("_run"), F.lit(RUN)).cast("int")
    many = counted.select(*columns, "_copies", runs.alias("_run"))
    return many.select(*columns, F.explode(F.sequence(F.lit(1), left)).alias("_copy")).select(*columns)
