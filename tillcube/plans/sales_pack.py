"""The sales analysis pack: rankings, customers, segments, shares and seasonality."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillcube.operators import reports
from tillcube.operators.segments import (
    member_summary,
    quartile_segments,
    seasonality,
    segment_summary,
    top_segment_share,
)
from tillcube.plans.olap_pack import sales_lines
from tillcube.sources.shared import materialize

MEASURE = "total_price"
GRAIN = ("country", "customer_id", "month")


def analysis_lines(lines: DataFrame) -> DataFrame:
    return sales_lines(lines, "analysis")


def country_ranking(sales: DataFrame) -> DataFrame:
    return reports.ranked(reports.totals_by(sales, ["country"], [MEASURE]), MEASURE, "country")


def customer_revenue(sales: DataFrame) -> DataFrame:
    return reports.ranked(reports.totals_by(sales, ["customer_id"], [MEASURE]), MEASURE, "customer_id")


def month_sales(sales: DataFrame) -> DataFrame:
    return reports.ranked(reports.totals_by(sales, ["month"], [MEASURE]), MEASURE, "month")


def country_segments(sales: DataFrame) -> DataFrame:
    return quartile_segments(reports.totals_by(sales, ["country"], [MEASURE]), MEASURE)


def build_reports(lines: DataFrame) -> dict[str, DataFrame]:
    """All reports, from sums per country, customer and month that are written once."""
    sums = materialize(reports.totals_by(analysis_lines(lines), GRAIN, [MEASURE]), "sales_sums")
    months, countries, customers = month_sales(sums), country_ranking(sums), customer_revenue(sums)
    segments = materialize(country_segments(sums), "country_segments")
    return {
        "country_by_month": reports.cross_tab(sums, "country", "month", MEASURE, reports.MONTHS).orderBy("country"),
        "month_ranking": months,
        "best_month": months.limit(1),
        "country_ranking": countries,
        "top_countries": countries.limit(10),
        "customer_revenue": customers,
        "top_customers": customers.limit(10),
        "customer_summary": member_summary(customers, MEASURE),
        "country_segments": reports.ranked(segments, MEASURE, "country"),
        "segment_summary": reports.ranked(segment_summary(segments, "country", MEASURE), "total_revenue", "segment"),
        "top_segment_share": top_segment_share(segments, MEASURE),
        "seasonality": seasonality(months, MEASURE),
    }
