"""The jobs on the command line: retail files in, warehouse tables and reports out.

    python -m tillcube.jobs star --source shop.csv --output out
    python -m tillcube.jobs integrate --source shop.csv --parts workbook --output out

A job that is run again into the same folder replaces what is there as a whole; ``warehouse.current_set`` tells where the
tables and reports of the last run that ended lie. What a job writes on the way is removed when it ends.

``--source`` is a CSV or Parquet file or directory, ``--parts`` a folder with one directory per
sheet; both may be repeated, and earlier ones win where lines are equal.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcube.functions.calendar import with_calendar
from tillcube.functions.money import without_lanes
from tillcube.operators import align, compare, narrow, profile, reports
from tillcube.operators.align import Source
from tillcube.operators.cleaning import RULES, clean, preparation_report, quality_counters, removal_funnel, with_value
from tillcube.plans import etl, integration, methods, normalized, olap_pack, order_file, sales_pack, star, star_history
from tillcube.session import build_session
from tillcube.sources import files, sinks
from tillcube.sources.shared import job, materialize
from tillcube.sources.warehouse import write_set


@dataclass
class Result:
    """What a job writes: tables as Parquet, reports as CSV, columns to lay a table out by."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)
    layout: dict[str, Sequence[str]] = field(default_factory=dict)


def read_sources(spark: SparkSession, sources: Sequence[str], parts: Sequence[str]) -> list[Source]:
    """One source per file and per sheet; the sheets are known from the listing of their files."""
    found = []
    for path in sources:
        name = PurePosixPath(path.rstrip("/")).name
        found.append(Source(files.read_retail_file(spark, path), name, PurePosixPath(name).suffix[1:], name))
    for path in parts:
        name = PurePosixPath(path.rstrip("/")).name
        for sheet in files.part_names(spark, path):
            lines = files.read_csv(spark, f"{path}/{sheet}", encoding=files.RETAIL_ENCODING)
            found.append(Source(lines, name, sheet, name))
    return found


def profile_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    stacked = materialize(align.stack_sources(sources), "stacked_sources")
    return Result(
        reports={
            "shape": profile.shape(stacked),
            "missing_values": profile.missing_values(stacked),
            "description": profile.describe(stacked),
            "rows_per_source": align.rows_per_source(stacked),
            "unparsed_values": unparsed(sources),
        }
    )


def unparsed(sources: Sequence[Source]) -> DataFrame:
    """Values of all sources that are there but do not parse."""
    return align.unparsed_values(align.stack([align.align(source.lines, fill_missing=True) for source in sources]))


def entities_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    return Result(tables=normalized.normalize(integration.contract_lines(sources)))


def star_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    tables = star.build_star(integration.contract_lines(sources))
    results = {"sales_by_country": star.sales_by_country(tables), "sales_trend_monthly": star.sales_by_month(tables)}
    return Result(tables, results)


def history_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    tables = star_history.build_star_history(integration.contract_lines(sources))
    results = {
        "sales_by_country": star_history.sales_by_country(tables),
        "sales_trend_monthly": star_history.sales_by_month(tables),
        "sales_by_product": star_history.sales_by_product(tables),
    }
    return Result(tables, results)


def load_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    built = etl.build_fact(integration.contract_lines(sources))
    built["unparsed_values"] = unparsed(sources)
    return Result({"fact_sales": built.pop("fact_sales")}, built, {"fact_sales": ("year", "month")})


def integrate_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    built = integration.integrate(sources)
    built["unparsed_values"] = unparsed(sources)
    tables = {name: built.pop(name) for name in ("fact_sales", "duplicates")}
    return Result(tables, built, {"fact_sales": ("year", "month")})


def olap_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    stacked = materialize(align.stack_sources(sources, fill_missing=False), "stacked_sources")
    results = olap_pack.build_reports(stacked, options.country, options.year)
    results["source_row_counts"] = align.rows_per_source(stacked)
    results["quality_report"] = quality_counters(stacked, RULES["olap"])
    return Result(reports=results)


def sales_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    stacked = materialize(align.stack_sources(sources, fill_missing=False), "stacked_sources")
    results = sales_pack.build_reports(stacked)
    results["removal_funnel"] = removal_funnel(stacked, RULES["analysis"])
    results["sample"] = sinks.first_rows(without_lanes(sales_pack.analysis_lines(stacked)), 1000)
    return Result(reports=results)


def narrow_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    """Types and sizes before and after narrowing, and reports over both forms."""
    lines = with_value(clean(integration.contract_lines(sources), RULES["prepare"]))
    before = materialize(with_calendar(lines, "invoice_date", "year", "month"), "prepared_lines")
    text = ["invoice_no", "stock_code", "description", "country"]
    small = narrow.narrow(before)
    coded, dictionaries = narrow.dictionary_encode(small, text)
    after = materialize(coded, "narrow_lines")
    chosen = {"before": before, "after": after.join(dictionaries["country"], "country_code", "left")}
    sizes = [
        profile.footprint(table).agg(F.lit(name).alias("version"), F.sum("bytes").alias("bytes"))
        for name, table in (("before", before), ("after", after))
    ]
    results = {
        "missing_values": profile.missing_values(before),
        "types": profile.types_before_after(before, small),
        "memory_comparison": compare.difference_to(align.stack(sizes), "version", "before", "bytes"),
    }
    totals = {}
    for name, table in chosen.items():
        countries = reports.totals_by(table, ["country"], ["total_price"])
        results[f"{name}_sales_by_country"] = reports.ranked(countries, "total_price", "country")
        results[f"{name}_sales_by_month"] = reports.totals_by(table, ["month"], ["total_price"]).orderBy("month")
        customers = reports.totals_by(table, ["customer_id"], ["total_price"])
        results[f"{name}_top10_customers"] = reports.top(customers, 10, "total_price", "customer_id")
        one_country = reports.members(table, {"country": options.country})
        results[f"{name}_one_country_sample"] = sinks.first_rows(one_country, 1000)
        high_value = table.where(F.col("total_price") > 1000)
        results[f"{name}_high_value_sample"] = sinks.first_rows(high_value, 1000)
        totals[name] = align.stack(
            [
                rows.agg(F.lit(operation).alias("operation"), F.count("*").alias("rows"))
                for operation, rows in (("filter_country", one_country), ("filter_high_value", high_value))
            ]
        )
    compared = compare.before_after(totals["before"], totals["after"], "operation", "rows")
    results["filter_summary"] = compared.select("operation", "before_value", "after_value")
    return Result({"narrow_lines": after, **{f"dictionary_{c}": d for c, d in dictionaries.items()}}, results)


def methods_job(sources: Sequence[Source], options: argparse.Namespace) -> Result:
    lines = integration.contract_lines(sources)
    normal = materialize(methods.bench_lines(lines), "bench_lines")
    results = {"preparation_report": preparation_report(lines, RULES["bench"])}
    for size, sales in (("normal", normal), ("large", sinks.replicate(normal, options.times))):
        results[f"{size}_groupby"] = methods.by_grouping(sales)
        results[f"{size}_pivot"] = methods.by_pivot(sales)
        results[f"{size}_pre_keyed"] = methods.by_grouping(methods.pre_keyed(sales))
    return Result(reports=results)


JOBS: dict[str, Callable[[Sequence[Source], argparse.Namespace], Result]] = {
    "profile": profile_job,
    "entities": entities_job,
    "star": star_job,
    "history": history_job,
    "load": load_job,
    "integrate": integrate_job,
    "olap": olap_job,
    "sales": sales_job,
    "narrow": narrow_job,
    "methods": methods_job,
}


def run(spark: SparkSession, arguments: Sequence[str]) -> None:
    parser = argparse.ArgumentParser(prog="tillcube.jobs")
    parser.add_argument("job", choices=["orders", *JOBS])
    parser.add_argument("--source", action="append", default=[])
    parser.add_argument("--parts", action="append", default=[])
    parser.add_argument("--output", required=True)
    parser.add_argument("--country", default="United Kingdom", help="member for slice and dice")
    parser.add_argument("--year", type=int, default=2011, help="year for dice")
    parser.add_argument("--times", type=int, default=5, help="stacking factor of the large data")
    options = parser.parse_args(arguments)
    if not options.source and not options.parts:
        parser.error("give at least one --source or --parts")
    with job(spark):
        if options.job == "orders":
            orders = align.stack([order_file.read_orders(spark, path) for path in options.source])
            result = Result(reports=order_file.build_reports(orders))
        else:
            result = JOBS[options.job](read_sources(spark, options.source, options.parts), options)
        write_set(spark, options.output, result.tables, result.reports, result.layout)


def main() -> None:
    spark = build_session("tillcube")
    try:
        run(spark, sys.argv[1:])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
