"""Dimension tables. Each is written once, so a job that uses it several times does not rebuild it
from the lines, and the optimizer knows its size when it plans the joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.contract import UNKNOWN_PRODUCT
from tillcube.functions.calendar import with_calendar
from tillcube.functions.filters import with_known
from tillcube.operators.numbering import number_rows
from tillcube.operators.reports import most_frequent


def country_dimension(lines: DataFrame, key: str = "country_key") -> DataFrame:
    names = lines.select(F.col("country").alias("country_name")).distinct()
    return number_rows(names, key, ["country_name"])


def product_dimension(lines: DataFrame, name: str = "product_name") -> DataFrame:
    """One row per stock code with its most frequent description."""
    products = most_frequent(lines, "stock_code", "description", UNKNOWN_PRODUCT, name)
    return number_rows(products, "product_key", ["stock_code"])


def date_dimension(lines: DataFrame, *parts: str) -> DataFrame:
    """One row per day with sales, with the named calendar parts."""
    days = with_known(lines, ["invoice_date"]).select(F.to_date("invoice_date").alias("date")).distinct()
    return with_calendar(number_rows(days, "date_key", ["date"]), "date", *parts)


def invoice_dimension(lines: DataFrame) -> DataFrame:
    """One row per invoice with its moment, date and hour."""
    invoices = lines.groupBy("invoice_no").agg(F.min("invoice_date").alias("invoice_date"))
    numbered = number_rows(invoices, "invoice_key", ["invoice_no"])
    numbered = numbered.withColumnRenamed("invoice_date", "invoice_datetime")
    return numbered.withColumns(
        {"invoice_date": F.to_date("invoice_datetime"), "invoice_hour": F.hour("invoice_datetime")}
    )


def customer_dimension(lines: DataFrame, countries: DataFrame, country_key: str) -> DataFrame:
    """One row per customer and country; lines need the ``customer_business_key``."""
    customers = lines.select(
        "customer_business_key", F.col("customer_id").alias("customer_id_source"), "country"
    ).distinct()
    customers = look_up(customers, countries, {"country": "country_name"}, country_key).drop("country")
    return number_rows(customers, "customer_key", ["customer_business_key", country_key])


def look_up(
    facts: DataFrame, dimension: DataFrame, on: Mapping[str, str], *columns: str, nullable: Sequence[str] = ()
) -> DataFrame:
    """Left-join columns of a dimension by its natural key (fact column: dimension column).

    Null is a value like any other in the fact columns named in ``nullable``, and finds nothing in others.

    The natural key is unique, so no fact is lost or doubled. Whether the dimension is broadcast is
    decided by its written size; past the threshold the join shuffles and adaptive execution splits
    hot keys.
    """
    renamed = {theirs: f"_{theirs}" for theirs in on.values()}
    small = dimension.select(*[F.col(theirs).alias(alias) for theirs, alias in renamed.items()], *columns)
    same = [
        F.col(ours).eqNullSafe(F.col(renamed[theirs])) if ours in nullable else F.col(ours) == F.col(renamed[theirs])
        for ours, theirs in on.items()
    ]
    return facts.join(small, same, "left").drop(*renamed.values())
