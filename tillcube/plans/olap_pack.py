"""The OLAP report pack: every report answered from one pre-aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.functions.calendar import with_calendar
from tillcube.functions.money import with_lanes
from tillcube.operators import reports
from tillcube.operators.cleaning import RULES, clean, with_value
from tillcube.sources.shared import materialize

MEASURES = ("total_price", "quantity")
GRAIN = ("country", "year", "month", "year_month", "stock_code", "description")


def sales_lines(lines: DataFrame, rules: str = "olap") -> DataFrame:
    """Cleaned lines with calendar parts and their value, with the lanes that sums are made from."""
    dated = with_calendar(clean(lines, RULES[rules]), "invoice_date", "year", "month", "day", "year_month")
    return with_lanes(with_value(dated), "total_price")


def by_year(sales: DataFrame) -> DataFrame:
    return reports.totals_by(sales, ["year"], MEASURES).orderBy("year")


def by_month(sales: DataFrame) -> DataFrame:
    return reports.totals_by(sales, ["year", "month"], MEASURES).orderBy("year", "month")


def one_country(sales: DataFrame, country: str) -> DataFrame:
    return by_month(reports.members(sales, {"country": country}))


def one_country_and_year(sales: DataFrame, country: str, year: int) -> DataFrame:
    chosen = reports.members(sales, {"country": country, "year": year})
    return reports.totals_by(chosen, ["month"], MEASURES).orderBy("month")


def top_countries(sales: DataFrame, count: int = 10) -> DataFrame:
    return reports.top(reports.totals_by(sales, ["country"], MEASURES), count, "total_price", "country")


def month_ranking(sales: DataFrame) -> DataFrame:
    months = reports.totals_by(sales, ["year", "month", "year_month"], MEASURES)
    return reports.ranked(months, "total_price", "year_month")


def country_by_year(sales: DataFrame) -> DataFrame:
    """Sums by country and year are written first: they tell which years there are, and are all that is pivoted."""
    sums = materialize(reports.totals_by(sales, ["country", "year"], ["total_price"]), "country_years")
    return reports.cross_tab(sums, "country", "year", "total_price")


def country_by_month(sales: DataFrame) -> DataFrame:
    return reports.cross_tab(sales, "country", "month", "total_price", reports.MONTHS)


def best_years(sales: DataFrame) -> DataFrame:
    years = reports.totals_by(sales, ["country", "year"], MEASURES)
    return reports.top_per_group(years, "country", 1, "total_price", "year")


def top_products(sales: DataFrame, count: int = 5) -> DataFrame:
    products = reports.totals_by(sales, ["country", "stock_code", "description"], MEASURES)
    return reports.top_per_group(products, "country", count, "total_price", "stock_code", "description")


def heat_map(sales: DataFrame, count: int = 15) -> DataFrame:
    """Rows of the country by month table for the largest countries."""
    totals = reports.totals_by(sales, ["country"], ["total_price"])
    leading = reports.top(totals, 10, "total_price", "country")
    largest = reports.top(totals, count, "total_price", "country")
    chosen = reports.merged_ranking([leading, largest], "country", "total_price", count)
    return reports.keep_members(country_by_month(sales), chosen, "country")


def build_reports(lines: DataFrame, country: str, year: int) -> dict[str, DataFrame]:
    """All reports. The lines are scanned and cleaned once; their sums at the finest grain any
    report needs are written and answer everything else."""
    sums = materialize(reports.totals_by(sales_lines(lines), GRAIN, MEASURES), "olap_sums")
    ranking = month_ranking(sums)
    return {
        "rollup_year": by_year(sums),
        "drilldown_year_month": by_month(sums),
        "slice_monthly": one_country(sums, country),
        "dice_monthly": one_country_and_year(sums, country, year),
        "pivot_country_year": country_by_year(sums).orderBy("country"),
        "top_countries": top_countries(sums),
        "month_ranking": ranking,
        "best_month": ranking.limit(1),
        "cube_country_month": country_by_month(sums).orderBy("country"),
        "best_year_by_country": best_years(sums).orderBy("country"),
        "top_products_by_country": top_products(sums).orderBy("country", F.col("total_price").desc(), "stock_code"),
        "heat_map": heat_map(sums).orderBy("country"),
    }
