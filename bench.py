"""Times the headline queries and prints one JSON line.

``queries`` holds seconds per registered query, from the raw tables to the last row of the result,
and, prefixed ``prepared_``, the reports whose published figures start from prepared data: there
the cleaned lines are written once beforehand (``prepare``), as they are and stacked, which at sf0.1
comes to about as many rows as the larger published data. ``load_csv`` reads and types one CSV.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcube.functions.money import without_lanes
from tillcube.operators import reports
from tillcube.operators.align import align, typed
from tillcube.plans import methods
from tillcube.plans.catalog import QUERIES
from tillcube.session import build_session
from tillcube.sources.files import RETAIL_ENCODING, read_retail_file
from tillcube.sources.sample_tables import retail_lines
from tillcube.sources.shared import materialize, new_path
from tillcube.sources.sinks import replicate, write_csv

# What is timed.
HEADLINES = (
    "etl_control_by_month",
    "sales_by_country",
    "invoices_per_customer",
    "top10_customers",
    "rollup_year",
    "pivot_country_month",
    "top5_products_by_country",
    "quality_report",
    "price_conflicts",
    "scd2_history",
    "scd2_interval_join",
    "kimball_fact",
    "star_fact",
    "integrate_sources",
    "olap_report_totals",
    "fact_row_ids",
    "csv_scan_latin1",
)
REPEATS = 2
STACKED = 13


def seconds(make: Callable[[], DataFrame], repeats: int = REPEATS) -> float:
    """Best time of building a result and reading all of it."""
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 4)


def prepared_reports(sales: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    measure = ["total_price"]
    customers = reports.totals_by(sales, ["customer_id"], measure)
    lines = without_lanes(sales)
    return {
        "sales_by_country": lambda: reports.ranked(reports.totals_by(sales, ["country"], measure), "total_price"),
        "sales_by_month": lambda: reports.totals_by(sales, ["year_month"], measure).orderBy("year_month"),
        "invoices_by_customer": lambda: reports.distinct_by(sales, "customer_id", "invoice_no", "invoices"),
        "top10_customers": lambda: reports.top(customers, 10, "total_price", "customer_id"),
        "filter_country": lambda: reports.members(lines, {"country": "NATION_3"}),
        "filter_value": lambda: lines.where(F.col("total_price") > 1000),
    }


def run(spark: SparkSession, folder: str) -> dict[str, float]:
    seconds(lambda: QUERIES["sales_by_country"](spark, folder), 1)
    timings = {name: seconds(lambda name=name: QUERIES[name](spark, folder)) for name in HEADLINES}
    path = f"{new_path(spark, 'bench')}/lines.csv"
    write_csv(retail_lines(spark, folder), path, RETAIL_ENCODING)
    timings["load_csv"] = seconds(lambda: typed(align(read_retail_file(spark, path))))
    start = time.perf_counter()
    normal = materialize(methods.bench_lines(retail_lines(spark, folder)), "prepared")
    large = materialize(replicate(normal, STACKED), "prepared-large")
    timings["prepare"] = round(time.perf_counter() - start, 4)
    for size, sales in (("normal", normal), ("large", large)):
        for name, make in prepared_reports(sales).items():
            timings[f"prepared_{size}_{name}"] = seconds(make, 3)
    return timings


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = run(spark, folder)
    total = round(sum(timings.values()), 4)
    scale = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
