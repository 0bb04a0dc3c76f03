"""The same three reports by three ways of aggregating, on the data as it is or stacked n times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.functions.filters import with_known
from tillcube.functions.money import exact_sum
from tillcube.operators import reports
from tillcube.operators.align import stack
from tillcube.plans.olap_pack import sales_lines
from tillcube.sources.shared import materialize_by_key


def bench_lines(lines: DataFrame) -> DataFrame:
    return sales_lines(lines, "bench")


def _stacked(country: DataFrame, month: DataFrame, customer: DataFrame) -> DataFrame:
    return stack(
        [
            reports.as_rows(country, "sales_by_country", "country", "total_price"),
            reports.as_rows(month, "sales_by_month", "year_month", "total_price"),
            reports.as_rows(customer, "invoices_by_customer", "customer_id", "invoices"),
        ]
    )


def by_grouping(sales: DataFrame) -> DataFrame:
    """One group-by per report over the lines."""
    return _stacked(
        reports.totals_by(sales, ["country"], ["total_price"]),
        reports.totals_by(sales, ["year_month"], ["total_price"]),
        reports.distinct_by(sales, "customer_id", "invoice_no", "invoices"),
    )


def by_pivot(sales: DataFrame) -> DataFrame:
    """A pivot whose only column is the measure itself; the key stays a column of the result."""
    measured = sales.withColumn("_measure", F.lit("total_price"))

    def pivoted(key: str, name: str, value: Column) -> DataFrame:
        grouped = with_known(measured, [key]).groupBy(key).pivot("_measure", ["total_price"])
        return grouped.agg(value).withColumnRenamed("total_price", name)

    return _stacked(
        pivoted("country", "total_price", F.sum("total_price")),
        pivoted("year_month", "total_price", F.sum("total_price")),
        pivoted("customer_id", "invoices", F.count_distinct("invoice_no")),
    )


def pre_keyed(sales: DataFrame) -> DataFrame:
    """Sums per country, month, customer and invoice, written once in buckets of the customer.

    This plays the part of an index on the keys. Moving the lines themselves to their key's
    partition would put a hot country into one task; sums do not grow with a key's lines. Reports by customer, alone or
    with other columns, find each customer's sums in one bucket and shuffle nothing.
    """
    keys = ("country", "year_month", "customer_id", "invoice_no")
    sums = sales.groupBy(*keys).agg(exact_sum(sales, "total_price").alias("total_price"))
    return materialize_by_key(sums, "pre_keyed", "customer_id")
