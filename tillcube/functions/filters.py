"""Row conditions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_known(names: Sequence[str]) -> Column:
    """True where none of the columns is null; unlike ``dropna`` it reaches the Parquet scan."""
    return reduce(lambda left, right: left & right, [F.col(name).isNotNull() for name in names], F.lit(True))


def with_known(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.where(all_known(names)) if names else df
