"""Duplicates: one row per key, all members of duplicate groups, conflicting prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.functions.filters import with_known

# Lines that agree on these columns should agree on the price.
PRICE_KEY = ("invoice_no", "stock_code", "customer_id", "invoice_date")


def count_copies(df: DataFrame, columns: Sequence[str] | None = None, name: str = "copies") -> DataFrame:
    """Distinct rows with the number of their copies; copies collapse before the shuffle."""
    return df.groupBy(*(columns or df.columns)).agg(F.count("*").alias(name))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one: all rows less the distinct ones."""
    return count_copies(df).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")
    )


def first_by_rank(df: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """One row per key with the lowest rank.

    ``keys`` must be all the columns wanted besides the rank, so that an integer minimum does it:
    a hash aggregate with a partial step, in which any number of copies takes one row per task.
    """
    return df.groupBy(*keys).agg(F.min(rank).alias(rank))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the lowest by ``order``, ties broken by the other columns.

    An aggregate, not a window: a key that holds a third of the table is reduced to one row inside
    each task that reads it.
    """
    others = [name for name in df.columns if name not in keys and name not in order]
    row = F.struct(*order, *others)
    # Copies of a row go first, which needs no sorting; of what is left there is less to compare.
    best = df.distinct().groupBy(*keys).agg(F.min(row).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def duplicate_members(
    df: DataFrame, keys: Sequence[str], rank: str | None = None, across_sources: bool = False
) -> DataFrame:
    """Every row of each key that occurs more than once.

    With ``across_sources`` only keys that occur in more than one source count. The repeated keys
    come from a partial aggregate and go back by a semi join, whose big side adaptive execution
    splits where one key is hot; no task ever holds a whole group.
    """
    if across_sources:
        if rank is None:
            raise ValueError("across_sources needs the rank column")
        repeated = df.groupBy(*keys).agg(F.min(rank).alias("_low"), F.max(rank).alias("_high"))
        repeated = repeated.where(F.col("_low") != F.col("_high"))
    else:
        repeated = count_copies(df, keys, "_n").where(F.col("_n") > 1)
    repeated = repeated.select(*[F.col(key).alias(f"_{key}") for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return df.join(repeated, same, "left_semi")


def duplicate_key_text(keys: Sequence[str]) -> Column:
    """The key's values joined by a bar, for reports only."""
    return F.concat_ws("|", *[F.col(key).cast("string") for key in keys])


def price_conflicts(lines: DataFrame) -> DataFrame:
    """Keys whose lines carry more than one price, with the range of prices."""
    return (
        with_known(lines, PRICE_KEY)
        .groupBy(*PRICE_KEY)
        .agg(
            F.min("unit_price").alias("min_unit_price"),
            F.max("unit_price").alias("max_unit_price"),
            F.count_distinct("unit_price").alias("unique_prices"),
            F.count("*").alias("rows_count"),
        )
        .where(F.col("unique_prices") > 1)
    )
