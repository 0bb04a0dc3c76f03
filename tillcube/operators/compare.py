"""Comparing two results: ratios, differences, equality of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.functions.filters import with_known
from tillcube.functions.measures import ratio


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    mean = F.sum(value).cast("double") / F.count(value)
    return with_known(df, keys).groupBy(*keys).agg(mean.alias(name))


def before_after(before: DataFrame, after: DataFrame, on: str, value: str) -> DataFrame:
    """Both measures of each name side by side, with their ratio and difference."""
    left = before.select(on, F.col(value).alias("before_value"))
    right = after.select(on, F.col(value).alias("after_value"))
    joined = left.join(right, on, "left")
    return joined.select(
        on,
        "before_value",
        "after_value",
        ratio(F.col("before_value"), F.col("after_value")).alias("ratio"),
        (F.col("after_value") - F.col("before_value")).alias("difference"),
    )


def difference_to(df: DataFrame, name: str, baseline: object, value: str) -> DataFrame:
    """Add each row's distance to the row called ``baseline`` in column ``name``."""
    base = df.where(F.col(name) == baseline).select(value).scalar()
    return df.withColumn("difference_vs_baseline", F.col(value) - base)


def rows_named(df: DataFrame, name: str, prefix: str) -> DataFrame:
    """Rows of a report whose name starts with ``prefix``."""
    return df.where(F.col(name).startswith(prefix))


def unequal_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often in both tables, with the surplus of the left one.

    Empty for equal tables. One aggregate over both sides: copies collapse before the shuffle.
    """
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    surplus = sides.groupBy(*left.columns).agg(F.sum("_side").alias("surplus"))
    return surplus.where(F.col("surplus") != 0)
