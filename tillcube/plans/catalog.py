"""Registered queries: every operator and job over the whole sample tables.

Each takes a session and a folder of tables and returns a DataFrame. Money is shown as double and
dates as text, so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcube.contract import COLUMNS, UNKNOWN_PRODUCT
from tillcube.functions import calendar, measures, money
from tillcube.functions.filters import with_known
from tillcube.operators import (
    align,
    cleaning,
    compare,
    dedup,
    history,
    narrow,
    numbering,
    profile,
    reports,
    segments,
    sketches,
)
from tillcube.operators.cleaning import RULES
from tillcube.plans import (
    dimensions,
    etl,
    integration,
    methods,
    normalized,
    olap_pack,
    sales_pack,
    star,
    star_history,
)
from tillcube.sources import files, sinks
from tillcube.sources.sample_tables import load_table, retail_lines, retail_sources
from tillcube.sources.shared import new_path

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that the queries and the SQL they are checked against share.
SLICE_COUNTRY = "NATION_3"
DICE_YEAR = 1997
HIGH_VALUE = 25_000
SPLIT_DATE = "1998-01-01"
LARGE_ORDER = 250_000
REPLICAS = 5

QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    casts = {}
    for name, spark_type in df.dtypes:
        if name == "quantity" and spark_type.startswith("decimal"):
            casts[name] = F.col(name).cast("bigint")  # whole in the sample tables
        elif spark_type.startswith("decimal"):
            casts[name] = F.col(f"`{name}`").cast("double")
        elif spark_type == "date":
            casts[name] = F.col(f"`{name}`").cast("string")
    return df.withColumns(casts) if casts else df


def registered(function: Query) -> Query:
    @wraps(function)
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return present(function(spark, folder))

    QUERIES[function.__name__] = query
    return function


def as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in names})


# ---- scans and sinks ---------------------------------------------------------------------------


def _raw_text(lines: DataFrame) -> DataFrame:
    """The lines as a retail file holds them: its header, slash dates, ids with a decimal."""
    date = F.date_format("invoice_date", "M/d/yy H:mm")
    names = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
    lines = lines.withColumns({"invoice_date": date, "customer_id": F.col("customer_id").cast("decimal(20,1)")})
    return lines.toDF(*names)


# The key of each table of the star.
WAREHOUSE_KEYS = {
    "dim_country": "country_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_date": "date_key",
    "fact_sales": "sales_fact_id",
}


@registered
def csv_scan_latin1(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{new_path(spark, 'retail')}/lines.csv"
    sinks.write_csv(_raw_text(retail_lines(spark, folder)), path, files.RETAIL_ENCODING)
    lines = files.read_csv(spark, path, encoding=files.RETAIL_ENCODING)
    return as_text(align.typed(align.align(lines)), "customer_id")


@registered
def csv_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{new_path(spark, 'control')}/totals.csv"
    facts = etl.fact_lines(cleaning.clean(retail_lines(spark, folder), RULES["basic"]))
    sinks.write_csv(etl.control_totals(facts, "country"), path)
    schema = "country string, revenue decimal(38,10), quantity decimal(26,4), transaction_lines bigint"
    return files.read_csv(spark, path, schema=schema)


@registered
def multi_part_source(spark: SparkSession, folder: str) -> DataFrame:
    first, *others = retail_sources(spark, folder)
    stored = []
    # The parts of one folder share a header; the first source has another.
    for name, parts in (("online", [first]), ("workbook", others)):
        path = new_path(spark, name)
        for source in parts:
            sinks.write_csv(align.trim_headers(source.lines), f"{path}/{source.sheet}", files.RETAIL_ENCODING)
        stored.append(align.typed(align.align(files.read_parts(spark, path), keep=["source_sheet"])))
    lines = align.stack(stored)
    return lines.groupBy("source_sheet").agg(
        F.count("*").alias("rows_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("unit_price").alias("unit_price"),
        F.count("customer_id").alias("known_customers"),
    )


@registered
def reader_by_suffix(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "suffix")
    lines = retail_lines(spark, folder)
    sinks.write_csv(_raw_text(lines), f"{path}/store.csv", files.RETAIL_ENCODING)
    lines.write.parquet(f"{path}/store.parquet")
    names = ("store.csv", "store.parquet")
    read = [files.read_retail_file(spark, f"{path}/{name}") for name in names]
    stacked = align.stack([align.typed(align.align(part, keep=["source_file"])) for part in read])
    value = measures.line_value(F.col("quantity"), F.col("unit_price"))
    return stacked.groupBy("source_file").agg(
        F.count("*").alias("rows_count"), F.sum(value).alias("net_value"), F.count("customer_id").alias("known_customers")
    )


@registered
def warehouse_sink_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "warehouse")
    tables = star.build_star(retail_lines(spark, folder), measures=False)
    days = tables["dim_date"].select("date_key", "year", "month")
    tables["fact_sales"] = tables["fact_sales"].join(days, "date_key", "left")
    sinks.write_warehouse(
        tables,
        path,
        {"fact_sales": ["year", "month"]},
        within={"fact_sales": ["date_key", WAREHOUSE_KEYS["fact_sales"]]},
        derived={"fact_sales": star.with_signed_measures},
    )
    stored = sinks.read_warehouse(spark, path, list(tables))
    # Of every table its rows and the sum of its keys, of the fact its amounts too.
    counts = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("rows_count"),
            F.sum(WAREHOUSE_KEYS[name]).alias("key_sum"),
            F.sum("sales_amount" if name == "fact_sales" else F.lit(0)).cast("double").alias("amount"),
        )
        for name, table in stored.items()
    ]
    return align.stack(counts)


@registered
def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(sinks.first_rows(retail_lines(spark, folder), 1000), "customer_id")


@registered
def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.first_rows(load_table(spark, folder, "orders"), 5)


@registered
def replicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    sales = sinks.replicate(methods.bench_lines(retail_lines(spark, folder)), REPLICAS)
    sums = [money.exact_sum(sales, name).alias(name) for name in olap_pack.MEASURES]
    return with_known(sales, ["country"]).groupBy("country").agg(
        *sums, F.count_distinct("invoice_no").alias("invoices"), F.count("*").alias("rows_count")
    )


# ---- schema and profile ------------------------------------------------------------------------


@registered
def schema_align_union(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(align.stack_sources(retail_sources(spark, folder)), "customer_id")


@registered
def rows_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return align.rows_per_source(align.stack_sources(retail_sources(spark, folder)))


@registered
def column_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_values(retail_lines(spark, folder))


@registered
def column_describe(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    orders = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)"))
    return profile.describe(orders).withColumn("std", F.round("std", 4))


@registered
def table_shape(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shape(retail_lines(spark, folder))


@registered
def type_report(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load_table(spark, folder, "lineitem")
    return profile.types_before_after(lineitem, narrow.narrow(lineitem))


@registered
def narrow_types(spark: SparkSession, folder: str) -> DataFrame:
    return narrow.type_advice(load_table(spark, folder, "lineitem"))


@registered
def column_footprint(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load_table(spark, folder, "lineitem")
    return profile.footprint_before_after(lineitem, narrow.narrow(lineitem))


@registered
def memory_comparison(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load_table(spark, folder, "lineitem")
    sizes = [
        profile.footprint(table).agg(F.lit(version).alias("version"), F.sum("bytes").alias("bytes"))
        for version, table in (("before", lineitem), ("after", narrow.narrow(lineitem)))
    ]
    return compare.difference_to(align.stack(sizes), "version", "before", "bytes")


@registered
def dictionary_encode(spark: SparkSession, folder: str) -> DataFrame:
    encoded, _ = narrow.dictionary_encode(load_table(spark, folder, "part"), ["p_brand", "p_type"])
    return encoded


# ---- projections -------------------------------------------------------------------------------


@registered
def typed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The text form of every line, typed again, with its value."""
    text = _raw_text(retail_lines(spark, folder))
    text = text.select(*[F.concat(F.lit(" "), F.col(name).cast("string")).alias(name) for name in text.columns])
    lines = align.typed(align.align(text))
    lines = lines.withColumns({name: F.trim(name) for name in cleaning.TEXT_COLUMNS})
    return as_text(cleaning.with_value(cleaning.fill_defaults(lines)), "customer_id")


@registered
def flags_and_signed_measures(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.with_signed_measures(retail_lines(spark, folder))
    lines = lines.withColumn("is_cancelled_any_case", measures.is_cancelled(F.lower("invoice_no"), any_case=True))
    return lines.drop("description", "country", "customer_id", "invoice_date")


@registered
def customer_business_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = normalized.with_business_key(cleaning.clean(retail_lines(spark, folder), RULES["keep_all"]))
    return reports.rows_by(lines, ["customer_business_key", "country"], "rows_count")


@registered
def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    parts = ("date", "year", "quarter", "month", "day", "weekday", "hour")
    return calendar.with_calendar(orders, "o_orderdate", *parts).drop("o_orderdate")


@registered
def period_text(spark: SparkSession, folder: str) -> DataFrame:
    orders = calendar.with_calendar(load_table(spark, folder, "orders"), "o_orderdate", "year", "month", "year_month")
    parts = calendar.period_of(F.col("year"), F.col("month"))
    return reports.rows_by(orders.withColumn("period", parts), ["year_month", "period"], "rows_count")


# ---- cleaning ----------------------------------------------------------------------------------


def _cleaned(rules: str) -> None:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        lines = cleaning.with_value(cleaning.clean(retail_lines(spark, folder), RULES[rules]))
        return as_text(lines, "customer_id")

    query.__name__ = f"clean_{rules}"
    registered(query)


for _rules in RULES:
    _cleaned(_rules)


@registered
def clean_integrated_sources(spark: SparkSession, folder: str) -> DataFrame:
    return integration.integrated_lines(retail_sources(spark, folder))


@registered
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.quality_counters(retail_lines(spark, folder), RULES["basic"])


@registered
def quality_report_sources(spark: SparkSession, folder: str) -> DataFrame:
    stacked = align.stack_sources(retail_sources(spark, folder))
    return cleaning.quality_counters(stacked, RULES["integrated"])


@registered
def preparation_report(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.preparation_report(retail_lines(spark, folder), RULES["bench"])


@registered
def removal_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.removal_funnel(align.stack_sources(retail_sources(spark, folder)), RULES["analysis"])


@registered
def duplicate_row_count(spark: SparkSession, folder: str) -> DataFrame:
    stacked = align.stack_sources(retail_sources(spark, folder))
    return dedup.duplicate_row_count(stacked.select(*COLUMNS))


@registered
def high_value_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = cleaning.with_value(retail_lines(spark, folder)).where(F.col("total_price") > HIGH_VALUE)
    return as_text(calendar.with_calendar(lines, "invoice_date", "year", "month", "day"), "customer_id")


@registered
def high_value_count_by_country(spark: SparkSession, folder: str) -> DataFrame:
    lines = cleaning.with_value(retail_lines(spark, folder)).where(F.col("total_price") > HIGH_VALUE)
    return reports.ranked(reports.rows_by(lines, ["country"], "transaction_count"), "transaction_count", "country")


# ---- plain aggregates --------------------------------------------------------------------------


def _valued(spark: SparkSession, folder: str) -> DataFrame:
    lines = money.with_lanes(cleaning.with_value(retail_lines(spark, folder), "total_value"), "total_value")
    return calendar.with_calendar(lines, "invoice_date", "year")


@registered
def total_sales(spark: SparkSession, folder: str) -> DataFrame:
    return reports.totals_by(_valued(spark, folder), [], ["total_value"])


@registered
def sales_by_country(spark: SparkSession, folder: str) -> DataFrame:
    totals = reports.totals_by(_valued(spark, folder), ["country"], ["total_value"])
    return reports.ranked(totals, "total_value", "country")


@registered
def sales_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return reports.totals_by(_valued(spark, folder), ["year"], ["total_value"]).orderBy("year")


@registered
def sales_by_country_year(spark: SparkSession, folder: str) -> DataFrame:
    totals = reports.totals_by(_valued(spark, folder), ["country", "year"], ["total_value"])
    return totals.orderBy("country", "year")


@registered
def sales_by_product(spark: SparkSession, folder: str) -> DataFrame:
    totals = reports.totals_by(_valued(spark, folder), ["description"], ["total_value"])
    return reports.ranked(totals, "total_value", "description")


@registered
def product_name_mode(spark: SparkSession, folder: str) -> DataFrame:
    lines = retail_lines(spark, folder)
    return reports.most_frequent(lines, "stock_code", "description", UNKNOWN_PRODUCT, "product_name")


@registered
def country_most_sold_product(spark: SparkSession, folder: str) -> DataFrame:
    lines = retail_lines(spark, folder)
    return reports.most_frequent(lines, "country", "description", UNKNOWN_PRODUCT, "product_name")


@registered
def price_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.price_conflicts(integration.integrated_lines(retail_sources(spark, folder)))


@registered
def invoices_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    sales = methods.bench_lines(retail_lines(spark, folder))
    counts = reports.distinct_by(sales, "customer_id", "invoice_no", "invoices")
    return reports.ranked(counts, "invoices", "customer_id")


@registered
def distinct_sketch_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices per country and year from sketches per country, customer and month, beside the exact count."""
    sales = methods.bench_lines(retail_lines(spark, folder))
    fine = sketches.distinct_sketches(sales, ["country", "customer_id", "year", "month"], "invoice_no")
    keys = ["country", "year"]
    estimated = sketches.rolled_up(fine, keys, "estimate")
    exact = with_known(sales, keys).groupBy(*keys).agg(F.count_distinct("invoice_no").alias("invoices"))
    near = sketches.within_error(F.col("estimate"), F.col("invoices")).alias("within_error")
    return exact.join(estimated, keys).select(*keys, "invoices", near)


@registered
def agg_by_grouping(spark: SparkSession, folder: str) -> DataFrame:
    return methods.by_grouping(methods.bench_lines(retail_lines(spark, folder)))


@registered
def agg_by_pivot_method(spark: SparkSession, folder: str) -> DataFrame:
    return methods.by_pivot(methods.bench_lines(retail_lines(spark, folder)))


@registered
def agg_prekeyed(spark: SparkSession, folder: str) -> DataFrame:
    return methods.by_grouping(methods.pre_keyed(methods.bench_lines(retail_lines(spark, folder))))


# ---- OLAP reports ------------------------------------------------------------------------------


def _olap(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.sales_lines(retail_lines(spark, folder))


@registered
def rollup_year(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.by_year(_olap(spark, folder))


@registered
def drilldown_year_month(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.by_month(_olap(spark, folder))


@registered
def rollup_with_totals(spark: SparkSession, folder: str) -> DataFrame:
    levels = reports.with_subtotals(_olap(spark, folder), ["year", "month"], olap_pack.MEASURES)
    return as_text(levels, "year", "month").fillna("all", ["year", "month"])


@registered
def cube_with_totals(spark: SparkSession, folder: str) -> DataFrame:
    levels = reports.with_subtotals(_olap(spark, folder), ["country", "month"], ["total_price"], cube=True)
    return as_text(levels, "month").fillna("all", ["country", "month"])


@registered
def slice_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.one_country(_olap(spark, folder), SLICE_COUNTRY)


@registered
def dice_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.one_country_and_year(_olap(spark, folder), SLICE_COUNTRY, DICE_YEAR)


@registered
def pivot_country_year(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.country_by_year(_olap(spark, folder))


@registered
def pivot_country_month(spark: SparkSession, folder: str) -> DataFrame:
    sales = sales_pack.analysis_lines(retail_lines(spark, folder))
    return olap_pack.country_by_month(sales)


@registered
def cube_country_month(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.country_by_month(_olap(spark, folder))


@registered
def best_year_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.best_years(_olap(spark, folder))


@registered
def top5_products_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.top_products(_olap(spark, folder))


@registered
def top10_countries(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.top_countries(_olap(spark, folder))


@registered
def month_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.month_ranking(_olap(spark, folder))


@registered
def best_month(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.month_ranking(_olap(spark, folder)).limit(1)


@registered
def semi_join_top_countries(spark: SparkSession, folder: str) -> DataFrame:
    sales = _olap(spark, folder)
    kept = reports.keep_members(sales, olap_pack.top_countries(sales), "country")
    return reports.totals_by(kept, ["country", "month"], olap_pack.MEASURES)


@registered
def heatmap_data(spark: SparkSession, folder: str) -> DataFrame:
    return olap_pack.heat_map(_olap(spark, folder))


@registered
def olap_report_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Grand total of each report of the pack."""
    lines = retail_lines(spark, folder)
    pack = olap_pack.build_reports(lines, SLICE_COUNTRY, DICE_YEAR)
    totals = []
    for name in ("rollup_year", "drilldown_year_month", "month_ranking", "slice_monthly", "dice_monthly"):
        totals.append(pack[name].agg(F.lit(name).alias("report"), F.sum("total_price").alias("total")))
    for name in ("pivot_country_year", "cube_country_month"):
        cells = [F.sum(f"`{cell}`") for cell in pack[name].columns if cell != "country"]
        totals.append(pack[name].agg(F.lit(name).alias("report"), sum(cells[1:], cells[0]).alias("total")))
    return align.stack([total.withColumn("total", F.col("total").cast("double")) for total in totals])


# ---- sales analysis ----------------------------------------------------------------------------


def _analysis(spark: SparkSession, folder: str) -> DataFrame:
    return sales_pack.analysis_lines(retail_lines(spark, folder))


@registered
def country_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return sales_pack.country_ranking(_analysis(spark, folder))


@registered
def top10_customers(spark: SparkSession, folder: str) -> DataFrame:
    return sales_pack.customer_revenue(_analysis(spark, folder)).limit(10)


@registered
def customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    customers = reports.totals_by(_analysis(spark, folder), ["customer_id"], [sales_pack.MEASURE])
    return segments.member_summary(customers, sales_pack.MEASURE)


@registered
def country_segments(spark: SparkSession, folder: str) -> DataFrame:
    return sales_pack.country_segments(_analysis(spark, folder))


@registered
def segment_summary(spark: SparkSession, folder: str) -> DataFrame:
    return segments.segment_summary(sales_pack.country_segments(_analysis(spark, folder)), "country", sales_pack.MEASURE)


@registered
def top_segment_share(spark: SparkSession, folder: str) -> DataFrame:
    return segments.top_segment_share(sales_pack.country_segments(_analysis(spark, folder)), sales_pack.MEASURE)


@registered
def seasonality_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return segments.seasonality(sales_pack.month_sales(_analysis(spark, folder)), sales_pack.MEASURE)


@registered
def analysis_report_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Grand total of each report of the pack."""
    pack = sales_pack.build_reports(retail_lines(spark, folder))
    names = ("month_ranking", "country_ranking", "customer_revenue", "country_segments")
    totals = [pack[name].agg(F.lit(name).alias("report"), F.sum(sales_pack.MEASURE).alias("total")) for name in names]
    summary = pack["segment_summary"]
    totals.append(summary.agg(F.lit("segment_summary").alias("report"), F.sum("total_revenue").alias("total")))
    return align.stack([total.withColumn("total", F.col("total").cast("double")) for total in totals])


# ---- comparisons -------------------------------------------------------------------------------


def _exact_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)"))


@registered
def mean_by_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = _exact_orders(spark, folder)
    means = compare.mean_by(orders, ["o_orderstatus", "o_orderpriority"], "o_totalprice", "mean_price")
    return means.orderBy("o_orderstatus", "mean_price")


@registered
def first_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = _exact_orders(spark, folder)
    return dedup.first_per_key(orders, ["o_orderstatus", "o_orderpriority"], ["o_totalprice", "o_orderkey"])


def _operations(orders: DataFrame) -> DataFrame:
    """Sum of all orders and number of large ones per priority, as named operations."""
    sums = orders.groupBy(F.concat(F.lit("sum_"), F.col("o_orderpriority")).alias("operation"))
    large = orders.where(F.col("o_totalprice") > LARGE_ORDER)
    counts = large.groupBy(F.concat(F.lit("filter_"), F.col("o_orderpriority")).alias("operation"))
    return align.stack(
        [
            sums.agg(F.sum("o_totalprice").cast("double").alias("measure")),
            counts.agg(F.count("*").cast("double").alias("measure")),
        ]
    )


@registered
def before_after_comparison(spark: SparkSession, folder: str) -> DataFrame:
    orders = _exact_orders(spark, folder)
    early = F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
    before, after = _operations(orders.where(early)), _operations(orders.where(~early))
    return compare.before_after(before, after, "operation", "measure")


@registered
def filter_summary(spark: SparkSession, folder: str) -> DataFrame:
    comparison = compare.rows_named(before_after_comparison(spark, folder), "operation", "filter_")
    return comparison.select("operation", "before_value", "after_value")


@registered
def encoding_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """Reports over the lines and over their narrow, dictionary-coded form; unequal rows are 0."""
    parts = ("month", "year")
    plain = calendar.with_calendar(cleaning.with_value(retail_lines(spark, folder)), "invoice_date", *parts)
    coded, dictionaries = narrow.dictionary_encode(narrow.narrow(plain), ["country"])
    decoded = coded.join(dictionaries["country"], "country_code", "left")
    results = []
    for key in ("country", "month", "customer_id"):
        left, right = (reports.totals_by(table, [key], ["total_price"]) for table in (plain, decoded))
        right = right.select(*[F.col(name).cast(spark_type).alias(name) for name, spark_type in left.dtypes])
        results.append(
            compare.unequal_rows(left, right).agg(
                F.lit(f"sales_by_{key}").alias("report"), F.count("*").alias("unequal_rows")
            ).withColumns(
                {
                    name: table.agg(F.sum("total_price")).scalar().cast("double")
                    for name, table in (("plain_total", left), ("decoded_total", right))
                }
            )
        )
    return align.stack(results)


# ---- keys, dimensions, history -----------------------------------------------------------------


@registered
def dim_country(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.country_dimension(cleaning.clean(retail_lines(spark, folder), RULES["star"]))


@registered
def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.product_dimension(cleaning.clean(retail_lines(spark, folder), RULES["star"]))


@registered
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    lines = cleaning.clean(retail_lines(spark, folder), RULES["star"])
    return dimensions.date_dimension(lines, "year", "quarter", "month", "day", "weekday")


@registered
def dim_invoice(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.invoice_dimension(cleaning.clean(retail_lines(spark, folder), RULES["star"]))


@registered
def lookup_product_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = retail_lines(spark, folder)
    products = dimensions.product_dimension(lines)
    found = dimensions.look_up(lines, products, {"stock_code": "stock_code"}, "product_key")
    return found.select("invoice_no", "stock_code", "product_key", "quantity", "unit_price")


@registered
def fact_row_ids(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = load_table(spark, folder, "lineitem")
    return numbering.number_rows(lineitem, "line_id", lineitem.columns, repeated=True)


@registered
def fact_row_ids_unordered(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers given without a sort: dense and unique, in no particular order."""
    numbered = numbering.number_rows(load_table(spark, folder, "lineitem"), "line_id")
    return numbered.agg(
        F.count("*").alias("rows_count"),
        F.min("line_id").alias("lowest_id"),
        F.max("line_id").alias("highest_id"),
        F.count_distinct("line_id").alias("distinct_ids"),
    )


@registered
def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    events = load_table(spark, folder, "events")
    return history.version_history(events, ["user_id"], "event_type", "ts")


@registered
def scd2_interval_join(spark: SparkSession, folder: str) -> DataFrame:
    """Composite key: the user and the tracked value, so versions of a key leave gaps."""
    events = load_table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    versions, moments = history.version_history_with_moments(events, ["user_id"], "event_type", "ts")
    columns = ["valid_from", "current_flag"]
    return history.attach_version_by_moment(events, moments, versions, ["user_id"], "ts", columns, ["event_type"])


@registered
def scd2_history_ties(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders")
    return history.version_history(orders, ["o_custkey"], "o_orderpriority", "o_orderdate")


@registered
def scd2_key_time_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    versions = scd2_history_ties(spark, folder)
    columns = ["o_orderpriority", "valid_from"]
    return history.attach_version(orders, versions, ["o_custkey"], "o_orderdate", columns)


# ---- warehouse jobs ----------------------------------------------------------------------------


@registered
def nf3_country(spark: SparkSession, folder: str) -> DataFrame:
    return normalized.build_entities(retail_lines(spark, folder), ["country"])[1]["country"]


@registered
def nf3_customer(spark: SparkSession, folder: str) -> DataFrame:
    customers = normalized.build_entities(retail_lines(spark, folder), ["country", "customer"])[1]["customer"]
    return as_text(customers, "customer_id_source")


@registered
def nf3_product(spark: SparkSession, folder: str) -> DataFrame:
    return normalized.build_entities(retail_lines(spark, folder), ["product"])[1]["product"]


@registered
def nf3_invoice(spark: SparkSession, folder: str) -> DataFrame:
    return normalized.invoices(*normalized.build_entities(retail_lines(spark, folder), ["country", "customer"]))


@registered
def nf3_invoice_line(spark: SparkSession, folder: str) -> DataFrame:
    return normalized.invoice_lines(*normalized.build_entities(retail_lines(spark, folder), ["product"]))


@registered
def kimball_fact(spark: SparkSession, folder: str) -> DataFrame:
    return star.build_star(retail_lines(spark, folder))["fact_sales"]


@registered
def net_gross_returns_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return star.sales_by_country(star.build_star(retail_lines(spark, folder)))


@registered
def net_gross_returns_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return star.sales_by_month(star.build_star(retail_lines(spark, folder)))


def _star_history(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The sample customers never move, so the order priority is the attribute with a history."""
    return star_history.build_star_history(retail_lines(spark, folder, "o_orderpriority"), "o_orderpriority")


@registered
def star_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _star_history(spark, folder)["fact_sales"]


@registered
def star_customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Versions by country, the attribute that retail customers change."""
    lines = cleaning.clean(retail_lines(spark, folder), RULES["star"])
    return star_history.customer_versions(lines, dimensions.country_dimension(lines), "country")


@registered
def star_sales_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return star_history.sales_by_country(_star_history(spark, folder))


@registered
def star_sales_trend(spark: SparkSession, folder: str) -> DataFrame:
    return star_history.sales_by_month(_star_history(spark, folder))


@registered
def star_sales_by_product(spark: SparkSession, folder: str) -> DataFrame:
    return star_history.sales_by_product(_star_history(spark, folder))


@registered
def etl_basic_fact(spark: SparkSession, folder: str) -> DataFrame:
    return etl.build_fact(retail_lines(spark, folder))["fact_sales"]


@registered
def etl_control_by_month(spark: SparkSession, folder: str) -> DataFrame:
    facts = etl.fact_lines(cleaning.clean(retail_lines(spark, folder), RULES["basic"]))
    return etl.control_totals(facts, "year", "month").orderBy("year", "month")


@registered
def etl_control_by_country(spark: SparkSession, folder: str) -> DataFrame:
    facts = etl.fact_lines(cleaning.clean(retail_lines(spark, folder), RULES["basic"]))
    return etl.control_totals(facts, "country")


@registered
def duplicate_members(spark: SparkSession, folder: str) -> DataFrame:
    return integration.duplicates(align.stack_sources(retail_sources(spark, folder)))


@registered
def cross_source_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return integration.duplicates(align.stack_sources(retail_sources(spark, folder)), across_sources=True)


@registered
def integrate_sources(spark: SparkSession, folder: str) -> DataFrame:
    return integration.integrate(retail_sources(spark, folder))["fact_sales"]


@registered
def integrated_rows_per_source(spark: SparkSession, folder: str) -> DataFrame:
    return align.rows_per_source(integration.integrated_lines(retail_sources(spark, folder)))
