"""Star schema that keeps returns, with net, gross and return measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.functions.calendar import period_of
from tillcube.functions.filters import with_known
from tillcube.functions.measures import (
    gross_part,
    is_cancelled,
    is_return,
    line_value,
    return_part,
)
from tillcube.operators.cleaning import RULES, clean
from tillcube.operators.numbering import number_rows, with_tie
from tillcube.operators.reports import net_gross_returns, ranked
from tillcube.plans.dimensions import (
    country_dimension,
    customer_dimension,
    date_dimension,
    look_up,
    product_dimension,
)
from tillcube.plans.normalized import with_business_key
from tillcube.sources.shared import materialize


def with_signed_measures(lines: DataFrame) -> DataFrame:
    """Sales amount split by sign, and the two flags."""
    lines = lines.withColumn("sales_amount", line_value(F.col("quantity"), F.col("unit_price")))
    amount = F.col("sales_amount")
    return lines.withColumns(
        {
            "gross_sales_amount": gross_part(amount),
            "return_amount": return_part(amount),
            "is_return": is_return(F.col("quantity")),
            "is_cancelled": is_cancelled(F.col("invoice_no")),
        }
    )


def build_star(lines: DataFrame, measures: bool = True) -> dict[str, DataFrame]:
    """Dimensions and ``fact_sales`` at the grain of one invoice line.

    Without ``measures`` the fact lacks those that follow from its other columns (:func:`with_signed_measures`).
    """
    written = materialize(clean(lines, RULES["keep_all"]), "prepared_lines")
    lines = with_business_key(written)
    country = country_dimension(lines)
    customer = customer_dimension(lines, country, "country_key")
    product = product_dimension(lines)
    date = date_dimension(lines, "year", "quarter", "month", "day")

    # Small dimensions come first: their keys are shorter than what they stand for, and lines move twice after them.
    facts = look_up(with_tie(written, "_tie"), country, {"country": "country_name"}, "country_key")
    facts = facts.withColumn("sold_on", F.to_date("invoice_date"))
    facts = look_up(facts, date, {"sold_on": "date"}, "date_key")
    # The business key is the id as text or follows from the country, so the id and the country stand for it.
    home = customer.select("customer_key", "customer_id_source", F.col("country_key").alias("home"))
    natural = {"customer_id": "customer_id_source", "country_key": "home"}
    facts = look_up(facts, home, natural, "customer_key", nullable=["customer_id"])
    facts = look_up(facts, product, {"stock_code": "stock_code"}, "product_key")
    facts = facts.select(
        "invoice_no", "customer_key", "product_key", "country_key", "date_key", "quantity", "unit_price", "_tie"
    )
    numbered = number_rows(facts, "sales_fact_id", facts.columns, tie="_tie")
    return {
        "dim_country": country,
        "dim_customer": customer,
        "dim_product": product,
        "dim_date": date,
        # The measures follow from the columns that are numbered, so they need not be sorted or written.
        "fact_sales": with_signed_measures(numbered) if measures else numbered,
    }


def sales_by_country(star: dict[str, DataFrame]) -> DataFrame:
    """The fact is summed by its surrogate key first; only the sums meet the dimension."""
    sums = net_gross_returns(star["fact_sales"], ["country_key"])
    named = sums.join(star["dim_country"], "country_key", "left").drop("country_key")
    return ranked(named, "net_sales", "country_name")


def sales_by_month(star: dict[str, DataFrame]) -> DataFrame:
    days = net_gross_returns(with_known(star["fact_sales"], ["date_key"]), ["date_key"])
    measures = ("net_sales", "gross_sales", "returns", "transaction_lines")
    months = (
        days.join(star["dim_date"].select("date_key", "year", "month"), "date_key", "left")
        .groupBy("year", "month")
        .agg(*[F.sum(name).alias(name) for name in measures])
    )
    return months.withColumn("period", period_of(F.col("year"), F.col("month"))).orderBy("year", "month")
