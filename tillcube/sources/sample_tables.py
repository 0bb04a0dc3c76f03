"""Invoice lines derived from the order tables that the driver provides.

The order tables hold neither returns nor gaps nor a second source, so fixed rules derive them:
returned lines become negative and cancelled, some customers, descriptions and prices go missing,
and the ship date splits the lines into two overlapping sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcube.contract import CONTRACT
from tillcube.operators.align import Source

# Ship dates that bound the two sources and the two sheets of the second one.
FIRST_SOURCE_END = "1999-01-01"
SECOND_SOURCE_START = "1998-07-01"
SECOND_SHEET_START = "2000-01-01"

# Schemas of the order tables; naming them spares a look into the files per scan.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# What a line has before it meets other tables: fewer and shorter columns to move than those they are made from.
def _flags() -> dict[str, Column]:
    returned = F.col("l_returnflag") == "R"
    return {
        "cancelled": returned & (F.col("l_linestatus") == "F"),
        "signed": F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")),
        "seventh": F.col("l_linenumber") == 7,
    }


def _priced() -> dict[str, Column]:
    free = (F.col("p_size") == 50) & F.col("seventh")
    price = F.col("list_price") + F.col("l_discount").cast("decimal(12,2)")
    return {
        "description": F.when(F.col("p_size") == 1, None).otherwise(F.col("p_name")),
        "quantity": F.col("signed").cast(CONTRACT["quantity"]),
        "unit_price": F.when(free, 0).otherwise(price).cast(CONTRACT["unit_price"]),
    }


def _line_columns() -> list[Column]:
    return [
        F.concat(
            F.when(F.col("cancelled"), "C").otherwise(""), F.col("l_orderkey").cast("string")
        ).alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("description"),
        F.col("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("unit_price"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", None)
        .otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        F.col("n_name").alias("country"),
    ]


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders, part, customer, nation = (
        load_table(spark, folder, name) for name in ("lineitem", "orders", "part", "customer", "nation")
    )
    # Customers and countries join the orders, of which there are fewer than lines.
    headers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    priced = part.withColumn("list_price", F.col("p_retailprice").cast("decimal(12,2)"))
    lines = lineitem.withColumns(_flags()).join(priced, F.col("l_partkey") == F.col("p_partkey"))
    return lines.withColumns(_priced()).join(headers, F.col("l_orderkey") == F.col("o_orderkey"))


def retail_lines(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """All order lines as invoice lines, with the named columns of the order tables kept."""
    return _joined(spark, folder).select(*_line_columns(), *extra)


def retail_sources(spark: SparkSession, folder: str) -> list[Source]:
    """The same lines as two overlapping sources; the second has two sheets and other headers."""
    shipped = F.col("l_shipdate")
    joined = _joined(spark, folder)

    def lines(condition: Column, headers: list[str]) -> DataFrame:
        return joined.where(condition).select(*_line_columns()).toDF(*headers)

    first = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    second = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", " Country "]
    early = (shipped >= SECOND_SOURCE_START) & (shipped < SECOND_SHEET_START)
    return [
        Source(lines(shipped < FIRST_SOURCE_END, first), "store_csv", "csv", "store.csv"),
        Source(lines(early, second), "web_workbook", "Year 1998-1999", "web"),
        Source(lines(shipped >= SECOND_SHEET_START, second), "web_workbook", "Year 2000-2001", "web"),
    ]
