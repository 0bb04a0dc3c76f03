"""Single-source load: cleaned fact table, quality report and control totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.functions.calendar import with_calendar
from tillcube.functions.measures import line_value
from tillcube.functions.money import with_lanes
from tillcube.operators import multiset
from tillcube.operators.cleaning import RULES, counters
from tillcube.operators.reports import ranked, totals_by

MEASURES = ("revenue", "quantity", "transaction_lines")


def fact_lines(lines: DataFrame) -> DataFrame:
    """Cleaned lines with calendar parts, revenue and a line counter."""
    lines = with_calendar(lines, "invoice_date", "year", "month", "day")
    return lines.withColumns(
        {"revenue": line_value(F.col("quantity"), F.col("unit_price")), "line_count": F.lit(1)}
    )


def control_totals(facts: DataFrame, *keys: str) -> DataFrame:
    counted = with_lanes(facts, "revenue").withColumnRenamed("line_count", "transaction_lines")
    return totals_by(counted, keys, MEASURES)


def build_fact(lines: DataFrame) -> dict[str, DataFrame]:
    """``fact_sales`` and the reports about it, all from the distinct lines, which are written once."""
    rules = RULES["basic"]
    rows = multiset.collapse(lines, rules)
    facts = fact_lines(multiset.kept(rows, rules))
    return {
        "fact_sales": facts.select(
            "invoice_no",
            "stock_code",
            "customer_id",
            "invoice_date",
            "year",
            "month",
            "day",
            "quantity",
            "unit_price",
            "revenue",
            "line_count",
        ),
        "quality_report": counters(rows, rules),
        "sales_by_country": ranked(control_totals(facts, "country"), "revenue", "country"),
        "sales_by_month": control_totals(facts, "year", "month").orderBy("year", "month"),
    }
