"""Profiles of a table: missing values, full description, types, size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcube.operators.dedup import count_copies
from tillcube.operators.quantiles import quantiles

# Bytes of one value of a fixed-width type.
WIDTHS = {
    "boolean": 1,
    "tinyint": 1,
    "smallint": 2,
    "int": 4,
    "date": 4,
    "float": 4,
    "bigint": 8,
    "double": 8,
    "timestamp": 8,
    "timestamp_ntz": 8,
}


def _width(spark_type: str) -> int:
    """Bytes of a fixed-width value; a decimal of up to 18 digits takes 8, a longer one 16."""
    if spark_type.startswith("decimal"):
        return 8 if int(spark_type[8:].split(",")[0]) <= 18 else 16
    return WIDTHS[spark_type]


def is_numeric(spark_type: str) -> bool:
    return spark_type in ("tinyint", "smallint", "int", "bigint", "float", "double") or spark_type.startswith(
        "decimal"
    )


def _per_column(row: DataFrame, names: Sequence[str], value_name: str) -> DataFrame:
    return row.unpivot([], list(names), "column_name", value_name)


def missing_values(df: DataFrame) -> DataFrame:
    """One row per column: (column_name, dtype, missing_values, missing_percent), from one scan.

    The percentage has two places, like the counters of the quality reports.
    """
    nulls = []
    for name in df.columns:
        missing = F.count_if(F.col(f"`{name}`").isNull())
        nulls.append(F.struct(missing.alias("n"), F.count("*").alias("rows")).alias(name))
    long = _per_column(df.agg(*nulls), df.columns, "found")
    dtypes = F.create_map(*[F.lit(text) for pair in df.dtypes for text in pair])
    hundredfold = F.col("found.n") * F.lit(100).cast("decimal(5,0)")
    percent = F.when(F.col("found.rows") > 0, hundredfold / F.col("found.rows"))
    return long.select(
        "column_name",
        F.element_at(dtypes, F.col("column_name")).alias("dtype"),
        F.col("found.n").alias("missing_values"),
        F.round(F.coalesce(percent, F.lit(0)), 2).alias("missing_percent"),
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("column_count"))


def types_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Column types of a table before and after a transform."""
    new = dict(after.dtypes)
    rows = [(name, spark_type, new.get(name)) for name, spark_type in before.dtypes]
    schema = "column_name string, type_before string, type_after string"
    return before.sparkSession.createDataFrame(rows, schema)


def _value_counts(df: DataFrame, names: Sequence[str], spark_type: str) -> DataFrame:
    """Distinct non-null values of all the columns with their counts, in one scan and one shuffle.

    Rows are unpivoted and counted inside the tasks, so only distinct values are shuffled.
    """
    pairs = df.select(*[F.col(f"`{name}`").cast(spark_type).alias(name) for name in names])
    long = _per_column(pairs, names, "value").where(F.col("value").isNotNull())
    return count_copies(long, name="copies")


def _numeric_summary(df: DataFrame, names: Sequence[str]) -> DataFrame:
    whole = ("tinyint", "smallint", "int", "bigint")
    dtypes = dict(df.dtypes)

    def summary(name: str) -> Column:
        value = F.col(f"`{name}`")
        # Whole numbers are summed as decimals, which large tables do not overflow.
        addend = value.cast("decimal(20,0)") if dtypes[name] in whole else value
        mean = F.try_divide(F.sum(addend).cast("double"), F.count(value).cast("double"))
        value = value.cast("double")
        return F.struct(
            F.count(value).alias("count"),
            mean.alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    row = df.agg(*[summary(name).alias(name) for name in names])
    stats = _per_column(row, names, "stats").select("column_name", "stats.*")
    counts = _value_counts(df, names, "double")
    quartiles = quantiles(counts, "column_name", "value", "copies", (0.25, 0.5, 0.75))
    return stats.join(quartiles, "column_name", "left")


def _text_summary(df: DataFrame, names: Sequence[str]) -> DataFrame:
    counts = _value_counts(df, names, "string")
    best = F.min(F.struct(-F.col("copies"), F.col("value").alias("text")))
    stats = counts.groupBy("column_name").agg(
        F.sum("copies").alias("count"),
        F.count("*").alias("unique_values"),
        best.alias("best"),
        F.max("copies").alias("top_count"),
    )
    return stats.select(
        "column_name", "count", "unique_values", F.col("best.text").alias("top_value"), "top_count"
    )


def describe(df: DataFrame) -> DataFrame:
    """Full description, one row per column.

    Text columns get unique_values, top_value (the lowest of equally frequent ones) and top_count;
    numeric ones mean, std, min, the exact quartiles and max.
    """
    numeric = [name for name, spark_type in df.dtypes if is_numeric(spark_type)]
    text = [name for name, spark_type in df.dtypes if not is_numeric(spark_type)]
    parts = []
    if text:
        parts.append(_text_summary(df, text))
    if numeric:
        parts.append(_numeric_summary(df, numeric))
    result = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    wanted = {
        "column_name": "column_name",
        "count": "value_count",
        "unique_values": "unique_values",
        "top_value": "top_value",
        "top_count": "top_count",
        "mean": "mean",
        "std": "std",
        "min": "min_value",
        "q0": "p25",
        "q1": "p50",
        "q2": "p75",
        "max": "max_value",
    }
    return result.select(*[F.col(old).alias(new) for old, new in wanted.items() if old in result.columns])


def footprint(df: DataFrame, name: str = "bytes") -> DataFrame:
    """Bytes held by the values of each column: text by its length, other types by their width."""

    def size(column: T.StructField) -> Column:
        spark_type = column.dataType.simpleString()
        value = F.col(f"`{column.name}`")
        if spark_type == "string":
            return F.coalesce(F.sum(F.octet_length(value)), F.lit(0)).cast("bigint")
        return F.count(value) * F.lit(_width(spark_type)).cast("bigint")

    row = df.agg(*[size(column).alias(column.name) for column in df.schema.fields])
    return _per_column(row, df.columns, name)


def footprint_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    both = footprint(before, "bytes_before").join(footprint(after, "bytes_after"), "column_name")
    return both.withColumn("difference_vs_before", F.col("bytes_after") - F.col("bytes_before"))
