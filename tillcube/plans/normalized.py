"""Third normal form: country, customer, product, invoice and invoice line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.functions.measures import business_key, is_cancelled, is_return
from tillcube.operators.cleaning import RULES, clean
from tillcube.operators.dedup import first_per_key
from tillcube.operators.numbering import number_rows
from tillcube.plans.dimensions import country_dimension, customer_dimension, look_up, product_dimension
from tillcube.sources.shared import materialize


def with_business_key(lines: DataFrame) -> DataFrame:
    return lines.withColumn("customer_business_key", business_key(F.col("customer_id"), F.col("country")))


ENTITIES = ("country", "customer", "product")


def build_entities(lines: DataFrame, wanted: Sequence[str] = ENTITIES) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Prepared lines and those of the three entities with surrogate keys that are wanted; customers need the
    countries.

    For several entities the prepared lines are written once; each then scans only the columns it needs.
    """
    lines = with_business_key(clean(lines, RULES["keep_all"]))
    lines = materialize(lines, "prepared_lines") if len(wanted) > 1 else lines
    entities = {}
    if "country" in wanted:
        entities["country"] = country_dimension(lines, "country_id")
    if "customer" in wanted:
        entities["customer"] = customer_dimension(lines, entities["country"], "country_id")
    if "product" in wanted:
        entities["product"] = product_dimension(lines, "description")
    return lines, entities


def invoices(lines: DataFrame, entities: dict[str, DataFrame]) -> DataFrame:
    """One row per invoice number; of several headers the lowest one stands.

    Headers are reduced to one per invoice before any key is looked up, so the lookups handle
    invoices, not lines.
    """
    header = lines.select(
        "invoice_no",
        "invoice_date",
        "customer_business_key",
        "country",
        is_cancelled(F.col("invoice_no")).alias("is_cancelled"),
    )
    header = first_per_key(header, ["invoice_no"], ["invoice_date", "customer_business_key", "country"])
    header = look_up(header, entities["country"], {"country": "country_name"}, "country_id")
    customer = entities["customer"].select("customer_key", "customer_business_key", F.col("country_id").alias("home"))
    natural = {"customer_business_key": "customer_business_key", "country_id": "home"}
    header = look_up(header, customer, natural, "customer_key")
    return header.select("invoice_no", "invoice_date", "customer_key", "country_id", "is_cancelled")


def invoice_lines(lines: DataFrame, entities: dict[str, DataFrame]) -> DataFrame:
    detail = look_up(lines, entities["product"], {"stock_code": "stock_code"}, "product_key")
    detail = detail.select("invoice_no", "product_key", "quantity", "unit_price")
    numbered = number_rows(detail, "invoice_line_id", detail.columns, repeated=True)
    return numbered.withColumn("is_return", is_return(F.col("quantity")))


def normalize(lines: DataFrame) -> dict[str, DataFrame]:
    """All five tables, ready for :func:`tillcube.sources.sinks.write_warehouse`."""
    lines, entities = build_entities(lines)
    return {
        **entities,
        "invoice": invoices(lines, entities),
        "invoice_line": invoice_lines(lines, entities),
    }
