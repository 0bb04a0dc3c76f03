"""Smaller encodings of a table: narrower integers, dictionary codes for repeated text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.operators.numbering import number_rows
from tillcube.operators.profile import is_numeric

# Integer types and the largest magnitude each holds.
INTEGER_TYPES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31), ("bigint", 2**63))


def type_advice(df: DataFrame) -> DataFrame:
    """Narrowest lossless type per numeric column, from one aggregate over the table.

    (column_name, dtype, min_value, max_value, narrow_type); a column with fractions keeps its type.
    """
    numeric = [(name, spark_type) for name, spark_type in df.dtypes if is_numeric(spark_type)]
    ranges = []
    for name, _ in numeric:
        value = F.col(f"`{name}`")
        whole = F.coalesce(F.every(value == F.floor(value)), F.lit(False))
        low, high = F.min(value).cast("double"), F.max(value).cast("double")
        ranges.append(F.struct(low.alias("low"), high.alias("high"), whole.alias("whole")).alias(name))
    long = df.agg(*ranges).unpivot([], [name for name, _ in numeric], "column_name", "found")
    dtypes = F.create_map(*[F.lit(text) for pair in numeric for text in pair])
    dtype = F.element_at(dtypes, F.col("column_name"))
    advice = dtype
    for spark_type, bound in reversed(INTEGER_TYPES):
        fits = F.col("found.whole") & (F.col("found.low") >= -float(bound)) & (F.col("found.high") < float(bound))
        advice = F.when(fits, spark_type).otherwise(advice)
    return long.select(
        "column_name",
        dtype.alias("dtype"),
        F.col("found.low").alias("min_value"),
        F.col("found.high").alias("max_value"),
        advice.alias("narrow_type"),
    )


def narrow(df: DataFrame) -> DataFrame:
    """Cast every numeric column to its narrowest lossless type.

    The advice is one row per column and is fetched to plan the casts.
    """
    chosen = {row.column_name: row.narrow_type for row in type_advice(df).collect()}
    current = dict(df.dtypes)
    casts = {name: F.col(f"`{name}`").cast(want) for name, want in chosen.items() if current[name] != want}
    return df.withColumns(casts) if casts else df


def dictionary(df: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct non-null values of a text column with dense codes 0..n-1 in sorted order."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    numbered = number_rows(values, code, [column])
    return numbered.withColumn(code, F.col(code) - 1)


def dictionary_encode(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace text columns by codes; returns the encoded table and the dictionary of each column.

    A missing value gets no code. The optimizer broadcasts a dictionary when its written size is
    small enough, and otherwise joins by shuffle with the hot values split.
    """
    names = df.columns
    dictionaries = {}
    for column in columns:
        code = f"{column}_code"
        dictionaries[column] = dictionary(df, column, code)
        df = df.join(dictionaries[column], column, "left")
        names = [code if name == column else name for name in names]
    return df.select(*names), dictionaries
