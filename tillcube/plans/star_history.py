"""Star schema with a versioned customer dimension and an invoice dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.functions.measures import line_value
from tillcube.functions.money import exact_sum, with_lanes
from tillcube.operators.cleaning import RULES, clean
from tillcube.operators.history import attach_version_by_moment, version_history, version_history_with_moments
from tillcube.operators.numbering import number_rows, with_tie
from tillcube.operators.reports import ranked
from tillcube.plans.dimensions import (
    country_dimension,
    date_dimension,
    invoice_dimension,
    look_up,
    product_dimension,
)
from tillcube.sources.shared import materialize


def customer_history(lines: DataFrame, tracked: str) -> DataFrame:
    """Numbered versions of every customer; a new one starts when the tracked attribute changes."""
    versions = version_history(lines, ["customer_id"], tracked, "invoice_date")
    return number_rows(versions, "customer_key", ["customer_id", "valid_from"])


def customer_versions(lines: DataFrame, country: DataFrame, tracked: str) -> DataFrame:
    """The customer dimension alone."""
    return _named_country(customer_history(lines, tracked), country, tracked)


def _named_country(customer: DataFrame, country: DataFrame, tracked: str) -> DataFrame:
    if tracked != "country":
        return customer
    customer = look_up(customer, country, {"country": "country_name"}, "country_key")
    return customer.withColumnRenamed("country", "country_name")


def build_star_history(lines: DataFrame, tracked: str = "country") -> dict[str, DataFrame]:
    """Dimensions and ``fact_sales``, which refers to them by surrogate keys only."""
    lines = materialize(clean(lines, RULES["star"]), "clean_lines")
    country = country_dimension(lines)
    product = product_dimension(lines)
    date = date_dimension(lines, "year", "quarter", "month", "day", "weekday")
    invoice = invoice_dimension(lines)
    versions, moments = version_history_with_moments(lines, ["customer_id"], tracked, "invoice_date", "customer_key")
    customer = materialize(versions, "customer_key")

    # Small dimensions come first: their keys are shorter than what they stand for, and lines move three times after them.
    facts = look_up(with_tie(lines, "_tie"), country, {"country": "country_name"}, "country_key")
    facts = facts.withColumn("sold_on", F.to_date("invoice_date"))
    facts = look_up(facts, date, {"sold_on": "date"}, "date_key")
    facts = attach_version_by_moment(facts, moments, customer, ["customer_id"], "invoice_date", ["customer_key"])
    facts = look_up(facts, invoice, {"invoice_no": "invoice_no"}, "invoice_key")
    facts = look_up(facts, product, {"stock_code": "stock_code"}, "product_key")
    facts = facts.select(
        "invoice_key",
        "customer_key",
        "product_key",
        "date_key",
        "country_key",
        "quantity",
        "unit_price",
        "_tie",
    )
    numbered = number_rows(facts, "sales_key", facts.columns, tie="_tie")
    revenue = line_value(F.col("quantity"), F.col("unit_price"))
    return {
        "dim_country": country,
        "dim_product": product,
        "dim_date": date,
        "dim_invoice": invoice,
        "dim_customer": _named_country(customer, country, tracked),
        "fact_sales": numbered.withColumns({"revenue": revenue, "line_count": F.lit(1)}),
    }


def _sums(fact: DataFrame, key: str) -> DataFrame:
    fact = with_lanes(fact, "revenue")
    return fact.groupBy(key).agg(
        exact_sum(fact, "revenue").alias("revenue"),
        exact_sum(fact, "quantity").alias("quantity"),
        F.sum("line_count").alias("lines"),
    )


def sales_by_country(star: dict[str, DataFrame]) -> DataFrame:
    sums = _sums(star["fact_sales"], "country_key")
    named = sums.join(star["dim_country"], "country_key", "left").drop("country_key")
    return ranked(named, "revenue", "country_name")


def sales_by_month(star: dict[str, DataFrame]) -> DataFrame:
    days = _sums(star["fact_sales"], "date_key")
    return (
        days.join(star["dim_date"].select("date_key", "year", "month"), "date_key", "left")
        .groupBy("year", "month")
        .agg(*[F.sum(name).alias(name) for name in ("revenue", "quantity", "lines")])
        .orderBy("year", "month")
    )


def sales_by_product(star: dict[str, DataFrame]) -> DataFrame:
    sums = _sums(star["fact_sales"], "product_key").drop("lines")
    named = sums.join(star["dim_product"], "product_key", "left").drop("product_key")
    return ranked(named, "revenue", "stock_code")
