"""Group, cube and ranking reports over cleaned lines or any pre-aggregate of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcube.functions.filters import with_known
from tillcube.functions.measures import total
from tillcube.functions.money import exact_sum, exact_sum_where, has_lanes, with_lanes

MONTHS = tuple(range(1, 13))


def totals_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum of each measure per key; rows without a key form no group."""
    return with_known(df, keys).groupBy(*keys).agg(*[exact_sum(df, name).alias(name) for name in measures])


def rows_by(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return with_known(df, keys).groupBy(*keys).agg(F.count("*").alias(name))


def distinct_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Distinct non-null values per key.

    Spark counts in two steps, first per key and value and then per key, so a hot key is spread
    over its values.
    """
    return with_known(df, [key]).groupBy(key).agg(F.count_distinct(value).alias(name))


def members(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """Slice (one condition) or dice (several): the rows of the given dimension members."""
    chosen = [F.col(name) == value for name, value in conditions.items()]
    return df.where(reduce(lambda left, right: left & right, chosen))


def with_subtotals(df: DataFrame, keys: Sequence[str], measures: Sequence[str], cube: bool = False) -> DataFrame:
    """All levels of a roll-up (or cube) in one pass; ``level`` tells them apart (0 is the finest).

    Only the sums of the finest level are expanded, not the rows.
    """
    finest = totals_by(df, keys, measures)
    grouped = finest.cube(*keys) if cube else finest.rollup(*keys)
    return grouped.agg(
        F.grouping_id().alias("level"), *[total(F.col(name)).alias(name) for name in measures]
    )


def cross_tab(
    df: DataFrame, row: str, column: str, measure: str, values: Sequence[object] | None = None
) -> DataFrame:
    """One row per member of ``row``, one column per member of ``column``, gaps filled with 0.

    Pass ``values`` where the members are known; otherwise Spark looks them up in a job of its own
    and refuses when there are too many of them to be columns.
    """
    sums = totals_by(df, [row, column], [measure])
    pivoted = sums.groupBy(row).pivot(column, list(values) if values else None).agg(F.sum(measure))
    cells = {name: F.coalesce(F.col(f"`{name}`"), F.lit(0)) for name in pivoted.columns if name != row}
    return pivoted.withColumns(cells)


def ranked(df: DataFrame, measure: str, *tie_breakers: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in tie_breakers])


def top(df: DataFrame, count: int, measure: str, *tie_breakers: str) -> DataFrame:
    """The ``count`` highest rows; each task keeps only its own candidates."""
    return ranked(df, measure, *tie_breakers).limit(count)


def top_per_group(df: DataFrame, group: str, count: int, measure: str, *tie_breakers: str) -> DataFrame:
    """The ``count`` highest rows of each group of an aggregated table.

    Spark cuts every group to ``count`` rows in each task before the shuffle.
    """
    order = [F.col(measure).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in tie_breakers]]
    ranks = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranks.where(F.col("_rank") <= count).drop("_rank")


def most_frequent(df: DataFrame, key: str, value: str, default: str, name: str) -> DataFrame:
    """The most frequent value per key, the lowest one on ties, ``default`` where there is none.

    Values are counted per key and value first, so no task holds all values of a hot key.
    """
    counts = with_known(df, [key]).groupBy(key, value).agg(F.count(value).alias("_n"))
    best = F.min(F.when(F.col(value).isNotNull(), F.struct(-F.col("_n"), F.col(value).alias("_value"))))
    return counts.groupBy(key).agg(F.coalesce(best["_value"], F.lit(default)).alias(name))


def keep_members(df: DataFrame, chosen: DataFrame, on: str) -> DataFrame:
    return df.join(chosen.select(on), on, "left_semi")


def merged_ranking(lists: Sequence[DataFrame], on: str, measure: str, count: int) -> DataFrame:
    """Union of ranked key lists, earlier lists first, each key once, cut to ``count`` keys.

    The lists hold ``on`` and ``measure`` and are short (top-k reports).
    """
    placed = [df.select(on, measure, F.lit(place).alias("_place")) for place, df in enumerate(lists)]
    joined = reduce(DataFrame.unionByName, placed)
    first = joined.groupBy(on).agg(F.min("_place").alias("_place"), F.max(measure).alias(measure))
    return first.orderBy("_place", F.col(measure).desc_nulls_last(), on).limit(count).select(on)


def net_gross_returns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net sales, gross sales, returns and line count per key of a fact with signed measures.

    A fact that has its quantity and price is summed by their whole units.
    """
    if {"quantity", "unit_price"} <= set(df.columns) and not has_lanes(df, "sales_amount"):
        df = with_lanes(df, "sales_amount")
    if has_lanes(df, "sales_amount"):
        return df.groupBy(*keys).agg(
            exact_sum(df, "sales_amount").alias("net_sales"),
            exact_sum_where(df, "sales_amount", lambda value: value > 0).alias("gross_sales"),
            exact_sum_where(df, "sales_amount", lambda value: value < 0).alias("returns"),
            F.count("sales_amount").alias("transaction_lines"),
        )
    return df.groupBy(*keys).agg(
        total(F.col("sales_amount")).alias("net_sales"),
        total(F.col("gross_sales_amount")).alias("gross_sales"),
        total(F.col("return_amount")).alias("returns"),
        F.count("sales_amount").alias("transaction_lines"),
    )


def as_rows(df: DataFrame, report: str, key: str, value: str) -> DataFrame:
    """A report as (report, key, value) rows, to be stacked with others."""
    columns: list[Column] = [
        F.lit(report).alias("report"),
        F.col(key).cast("string").alias("key"),
        F.col(value).cast("double").alias("value"),
    ]
    return df.select(*columns)
