"""Reports over a plain order file: one row per order with product, country, quantity and price."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcube.functions.calendar import with_calendar
from tillcube.functions.measures import line_value
from tillcube.functions.money import with_lanes, without_lanes
from tillcube.operators.reports import ranked, rows_by, totals_by
from tillcube.sources.files import read_csv

SCHEMA = (
    "order_id int, order_date date, customer_name string, product_name string, category string, "
    "quantity decimal(16,4), unit_price decimal(18,6), country string"
)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema=SCHEMA)


def with_total_value(orders: DataFrame) -> DataFrame:
    valued = orders.withColumn("total_value", line_value(F.col("quantity"), F.col("unit_price")))
    return with_calendar(valued, "order_date", "year", "month", "day")


def build_reports(orders: DataFrame, high_value: int = 1000) -> dict[str, DataFrame]:
    orders = with_lanes(with_total_value(orders), "total_value")
    high = without_lanes(orders).where(F.col("total_value") > high_value)
    measure = ["total_value"]
    return {
        "total_sales": totals_by(orders, [], measure),
        "sales_by_country": ranked(totals_by(orders, ["country"], measure), "total_value", "country"),
        "sales_by_product": ranked(totals_by(orders, ["product_name"], measure), "total_value", "product_name"),
        "sales_by_year": totals_by(orders, ["year"], measure).orderBy("year"),
        "sales_by_country_year": totals_by(orders, ["country", "year"], measure).orderBy("country", "year"),
        "high_value_sales": high,
        "high_value_count_by_country": ranked(
            rows_by(high, ["country"], "transaction_count"), "transaction_count", "country"
        ),
    }
