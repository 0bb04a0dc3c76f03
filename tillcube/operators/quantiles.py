"""Exact, linearly interpolated quantiles of columns of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcube.operators.numbering import POSITION_BITS
from tillcube.sources.shared import materialize


def _position(total: Column, probability: float) -> Column:
    return (total - 1) * F.lit(probability)


def quantiles(counts: DataFrame, group: str, value: str, copies: str, probabilities: Sequence[float]) -> DataFrame:
    """One row per group with columns q0, q1, ... for the given probabilities.

    ``counts`` holds each distinct value of a group once, with its number of copies; groups are few
    (the columns of a table), their values may be many. The values are sorted by range partitioning
    and written; the sums of the written pieces tell which pieces hold a wanted position, and only
    those are looked at value by value. No task sees a whole group.
    """
    ordered = counts.select(group, value, copies).where(F.col(value).isNotNull()).orderBy(group, value)
    staged = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "quantiles")
    staged = staged.withColumn("_piece", F.shiftright("_at", POSITION_BITS))
    pieces = staged.groupBy(group, "_piece").agg(F.sum(copies).alias("_rows"))
    by_group = Window.partitionBy(group)
    earlier = by_group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        group,
        "_piece",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(by_group).alias("_total"),
    )
    ends = [end(_position(F.col("_total"), p)) for p in probabilities for end in (F.floor, F.ceil)]
    start, stop = F.col("_before"), F.col("_before") + F.col("_rows")
    wanted = F.lit(False)
    for end in ends:
        wanted = wanted | ((end >= start) & (end < stop))
    # At most two pieces per group and probability are wanted, which bounds what is broadcast.
    rows = staged.join(F.broadcast(pieces.where(wanted).drop("_rows")), [group, "_piece"])
    running = Window.partitionBy(group, "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_stop", F.col("_before") + F.sum(copies).over(running))
    start, stop = F.col("_stop") - F.col(copies), F.col("_stop")
    found = rows.groupBy(group).agg(
        F.max("_total").alias("_total"),
        *[
            F.max(F.when((end >= start) & (end < stop), F.col(value).cast("double"))).alias(f"_end{number}")
            for number, end in enumerate(ends)
        ],
    )
    columns = []
    for number, probability in enumerate(probabilities):
        low, high = F.col(f"_end{2 * number}"), F.col(f"_end{2 * number + 1}")
        at = _position(F.col("_total"), probability)
        columns.append((low + (high - low) * (at - F.floor(at))).alias(f"q{number}"))
    return found.select(group, *columns)
