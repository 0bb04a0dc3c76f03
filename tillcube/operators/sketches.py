"""Distinct counts that roll up: mergeable sketches beside the exact count.

Exact distinct counts cannot be added up: a month's customers are not a year's. A sketch per fine group is a few kilobytes,
whatever it counted, and the sketches of several groups merge into that of their union. So one pre-aggregate, written
once, answers distinct counts at every coarser level without going back to the lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.functions.filters import with_known
from tillcube.sources.shared import materialize

# Base-2 logarithm of a sketch's registers, and the relative standard error that comes with it.
REGISTERS = 12
STANDARD_ERROR = 1.04 / 2 ** (REGISTERS / 2)


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` and ``sketch``, the distinct non-null values of each group, written once.

    Sketches are built where the rows are read and merged after the shuffle, so a hot group is as many small sketches as
    tasks read it.
    """
    known = with_known(df, [*keys, value])
    text = F.col(value).cast("string")
    return materialize(known.groupBy(*keys).agg(F.hll_sketch_agg(text, REGISTERS).alias("sketch")), "sketches")


def rolled_up(sketches: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Estimated distinct values per coarser key."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("_sketch"))
    return merged.select(*keys, F.hll_sketch_estimate("_sketch").alias(name))


def within_error(estimate: Column, exact: Column, deviations: float = 4.0) -> Column:
    """Whether an estimate is as near as so many standard errors allow; small counts may be off by one."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(deviations * STANDARD_ERROR))
