"""Numbers, quantiles, reports, segments, profiles and encodings on small tables."""

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from retail import line, lines, plain

from tillcube.functions import measures
from tillcube.functions.calendar import period_of, with_calendar
from tillcube.operators import compare, narrow, numbering, profile, reports, segments
from tillcube.operators.dedup import count_copies
from tillcube.operators.numbering import number_rows, with_tie
from tillcube.operators.quantiles import quantiles
from tillcube.plans import methods, order_file
from tillcube.plans.dimensions import look_up
from tillcube.sources.shared import materialize
from tillcube.sources.sinks import first_rows, replicate


@pytest.fixture(scope="module")
def sales(spark):
    rows = [("a", 1, 10), ("a", 2, 20), ("b", 1, 5), (None, 1, 99), ("c", 2, None)]
    return spark.createDataFrame(rows, "country string, month int, total_price int")


def test_missing_keys_form_no_group_and_no_value_sums_to_zero(sales):
    assert plain(reports.totals_by(sales, ["country"], ["total_price"])) == [("a", 30), ("b", 5), ("c", 0)]


def test_rows_and_distinct_values(sales):
    assert plain(reports.rows_by(sales, ["country"], "n")) == [("a", 2), ("b", 1), ("c", 1)]
    assert plain(reports.distinct_by(sales, "month", "country", "n")) == [(1, 2), (2, 2)]


def test_cross_tab_fills_gaps(sales):
    table = reports.cross_tab(sales, "country", "month", "total_price", (1, 2, 3))
    assert plain(table) == [("a", 10, 20, 0), ("b", 5, 0, 0), ("c", 0, 0, 0)]
    assert reports.cross_tab(sales, "country", "month", "total_price").columns == ["country", "1", "2"]


def test_slice_and_dice(sales):
    assert reports.members(sales, {"country": "a"}).count() == 2
    assert plain(reports.members(sales, {"country": "a", "month": 2}), "total_price") == [(20,)]


def test_subtotals(sales):
    levels = reports.with_subtotals(sales, ["country", "month"], ["total_price"])
    assert plain(levels.where("level = 3"), "total_price") == [(35,)]
    cube = reports.with_subtotals(sales, ["country", "month"], ["total_price"], cube=True)
    assert plain(cube.where("level = 2"), "month", "total_price") == [(1, 15), (2, 20)]


def test_ranking_puts_missing_last_and_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", 2)], "k string, v int")
    assert [row.k for row in reports.ranked(df, "v", "k").collect()] == ["d", "a", "b", "c"]
    assert [row.k for row in reports.top(df, 2, "v", "k").collect()] == ["d", "a"]


def test_top_per_group(spark):
    df = spark.createDataFrame([("x", n, n % 3) for n in range(9)] + [("y", 1, 1)], "g string, id int, v int")
    assert plain(reports.top_per_group(df, "g", 2, "v", "id"), "g", "id") == [("x", 2), ("x", 5), ("y", 1)]


def test_most_frequent_takes_the_lowest_on_ties(spark):
    rows = [(1, "z"), (1, "y"), (1, None), (1, None), (2, None), (3, "b"), (3, "b"), (3, "a"), (None, "q")]
    df = spark.createDataFrame(rows, "k int, v string")
    assert plain(reports.most_frequent(df, "k", "v", "none", "best")) == [(1, "y"), (2, "none"), (3, "b")]


def test_merged_ranking(spark):
    first = spark.createDataFrame([("a", 9), ("b", 8)], "k string, v int")
    second = spark.createDataFrame([("a", 9), ("b", 8), ("c", 7), ("d", 6)], "k string, v int")
    assert [row.k for row in reports.merged_ranking([first, second], "k", "v", 3).collect()] == ["a", "b", "c"]


@pytest.mark.parametrize("order_by", [None, ["k"]])
def test_numbers_are_dense(spark, order_by):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 37 % 1000).alias("k"))
    numbered = number_rows(df, "n", order_by).collect()
    assert sorted(row.n for row in numbered) == list(range(1, 1001))
    if order_by:
        assert all(row.n == row.k + 1 for row in numbered)


def test_numbers_of_equal_rows(spark):
    df = spark.range(300, numPartitions=5).select(F.lit("same").alias("k"))
    assert sorted(r.n for r in number_rows(df, "n", ["k"], repeated=True).collect()) == list(range(1, 301))
    mixed = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    assert plain(number_rows(mixed, "n", ["k"], repeated=True)) == [(1, "a"), (2, "b"), (3, "b"), (4, None)]


def test_numbers_of_equal_rows_that_are_told_apart(spark, monkeypatch):
    written = []
    monkeypatch.setattr(numbering, "materialize", lambda df, label: written.append(materialize(df, label)) or written[-1])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    rows = spark.range(4000, numPartitions=4).select(
        F.when(F.col("id") % 4 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 5 > 0, F.lit(1)).alias("v"),
    )
    counted = number_rows(rows, "n", ["k", "v"], repeated=True)
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        tied = number_rows(with_tie(materialize(rows, "rows"), "_tie"), "n", ["k", "v"], tie="_tie")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert tied.columns == ["n", "k", "v"] and plain(tied) == plain(counted)
    # Copies of one row are dealt out: no written partition holds most of them.
    hot = written[-1].where("k = 'hot' and v = 1").groupBy(F.shiftright("_at", 33)).count()
    assert max(row["count"] for row in hot.collect()) < 1600


def test_look_up_finds_null_where_it_may(spark):
    facts = spark.createDataFrame([(1,), (None,), (2,)], "a int")
    dimension = spark.createDataFrame([(1, 10), (None, 30)], "b int, k int")
    assert plain(look_up(facts, dimension, {"a": "b"}, "k", nullable=["a"])) == [(1, 10), (2, None), (None, 30)]
    assert plain(look_up(facts, dimension, {"a": "b"}, "k")) == [(1, 10), (2, None), (None, None)]


def test_numbers_of_no_rows(spark):
    assert number_rows(spark.range(0).toDF("k"), "n", ["k"]).count() == 0


def test_numbers_over_several_written_files(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.range(5000, numPartitions=4).select((F.col("id") * 7919 % 5000).alias("k"))
        numbered = number_rows(df, "n", ["k"])
        assert "_offset" in numbered._jdf.queryExecution().toString()
        assert numbered.where("n <> k + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_quantiles_against_plain_python(spark, coalesce):
    generator = random.Random(3)
    values = {"few": [generator.randrange(6) for _ in range(301)], "many": [generator.random() for _ in range(500)]}
    values["one"] = [4.0]
    rows = [(name, float(value)) for name, column in values.items() for value in column]
    df = spark.createDataFrame(rows + [("few", None)], "name string, value double")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        found = quantiles(count_copies(df), "name", "value", "copies", (0.0, 0.25, 0.5, 0.75, 1.0)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for row in found:
        column = sorted(values[row.name])
        cuts = statistics.quantiles(column, n=4, method="inclusive") if len(column) > 1 else column * 3
        assert list(row)[1:] == pytest.approx([column[0], *cuts, column[-1]])
    assert len(found) == 3


def test_segments_include_their_thresholds(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)], "k string, v int")
    found = segments.quartile_segments(df, "v")
    assert plain(found, "k", "segment") == [
        ("a", "bottom_25"),
        ("b", "bottom_25"),
        ("c", "middle_50"),
        ("d", "top_25"),
        ("e", "top_25"),
    ]
    assert segments.top_segment_share(found, "v").first()[0] == pytest.approx(60.0)
    assert plain(segments.segment_summary(found, "k", "v"))[0] == ("bottom_25", 2, 3, 1.5)


def test_seasonality_without_sales_in_the_worst_month(spark):
    df = spark.createDataFrame([(1, 5), (2, 0)], "month int, v int")
    assert segments.seasonality(df, "v").first().seasonality_ratio == 0.0


def test_signed_parts_and_business_key(spark):
    df = lines(spark, line(quantity=-2), line(), line(customer_id=None))
    value = measures.line_value(F.col("quantity"), F.col("unit_price"))
    parts = df.select(value, measures.gross_part(value), measures.return_part(value)).collect()
    assert [tuple(map(float, row)) for row in parts] == [(-3, 0, -3), (3, 3, 0), (3, 3, 0)]
    keys = df.select(measures.business_key(F.col("customer_id"), F.col("country"))).collect()
    assert [row[0] for row in keys] == ["7", "7", "UNKNOWN_France"]


def test_calendar(spark):
    df = spark.sql("select timestamp_ntz '2010-12-01 08:26:00' as at")
    parts = ("date", "year", "quarter", "month", "day", "weekday", "hour", "year_month")
    row = with_calendar(df, "at", *parts).first()
    assert (row.year, row.quarter, row.month, row.day, row.hour) == (2010, 4, 12, 1, 8)
    assert (row.weekday, row.year_month, str(row.date)) == ("Wednesday", "2010-12", "2010-12-01")
    assert spark.range(1).select(period_of(F.lit(2011), F.lit(3))).first()[0] == "2011-03"


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "n int, t string")
    assert plain(profile.missing_values(df)) == [("n", "int", 0, 0.0), ("t", "string", 2, 66.67)]
    assert tuple(profile.shape(df).first()) == (3, 2)
    assert plain(profile.missing_values(df.limit(0))) == [("n", "int", 0, 0.0), ("t", "string", 0, 0.0)]


def test_describe(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b"), (None, None)], "n int, t string")
    rows = {row.column_name: row for row in profile.describe(df).collect()}
    number, text = rows["n"], rows["t"]
    assert (number.value_count, number.mean, number.p25, number.p50, number.p75) == (4, 2.5, 1.75, 2.5, 3.25)
    assert (number.min_value, number.max_value, number.unique_values) == (1.0, 4.0, None)
    assert number.std == pytest.approx(statistics.stdev([1, 2, 3, 4]))
    assert (text.value_count, text.unique_values, text.top_value, text.top_count, text.mean) == (4, 2, "a", 2, None)
    assert [c for c in profile.describe(df.select("t")).columns if c == "mean"] == []


def test_narrow_types_lose_nothing(spark):
    rows = [(127, -129, 40000, 1.0, 2.5, None), (-128, 0, 0, 3.0, 1.0, 3)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint, d double, e double, f bigint")
    small = narrow.narrow(df)
    assert [t for _, t in small.dtypes] == ["tinyint", "smallint", "int", "tinyint", "double", "tinyint"]
    assert plain(small) == plain(df)
    sizes = profile.footprint_before_after(df, small)
    assert plain(sizes)[0] == ("a", 16, 2, -14)


def test_dictionary_codes(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4)], "t string, n int")
    encoded, dictionaries = narrow.dictionary_encode(df, ["t"])
    assert encoded.columns == ["t_code", "n"]
    assert plain(encoded, "n", "t_code") == [(1, 1), (2, 0), (3, None), (4, 1)]
    assert plain(dictionaries["t"], "t", "t_code") == [("a", 0), ("b", 1)]


def test_comparisons(spark):
    before = spark.createDataFrame([("sum_a", 4.0), ("filter_a", 3.0)], "operation string, t double")
    after = spark.createDataFrame([("sum_a", 2.0), ("filter_a", 0.0)], "operation string, t double")
    table = compare.before_after(before, after, "operation", "t")
    assert plain(table) == [("filter_a", 3.0, 0.0, 0.0, -3.0), ("sum_a", 4.0, 2.0, 2.0, -2.0)]
    assert plain(compare.rows_named(table, "operation", "filter_"), "operation") == [("filter_a",)]
    assert plain(compare.difference_to(before, "operation", "sum_a", "t"), "difference_vs_baseline") == [(-1.0,), (0.0,)]
    assert plain(compare.mean_by(before, ["operation"], "t", "m")) == [("filter_a", 3.0), ("sum_a", 4.0)]


def test_unequal_rows(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    right = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    assert plain(compare.unequal_rows(left, right)) == [(1, 1), (3, -1)]
    assert compare.unequal_rows(left, left).count() == 0


def test_sample_is_repeatable(spark):
    df = spark.createDataFrame([(3, "x"), (1, "z"), (1, "y"), (None, "a")], "a int, b string")
    assert [tuple(row) for row in first_rows(df, 3).collect()] == [(1, "y"), (1, "z"), (3, "x")]


def test_replicated_sums_scale_and_distinct_counts_do_not(spark, small):
    from tillcube.sources.sample_tables import retail_lines

    sales = methods.bench_lines(retail_lines(spark, small))
    once = {(r.report, r.key): r.value for r in methods.by_grouping(sales).collect()}
    five = {(r.report, r.key): r.value for r in methods.by_grouping(replicate(sales, 5)).collect()}
    for (report, key), value in once.items():
        times = 1 if report == "invoices_by_customer" else 5
        assert five[report, key] == pytest.approx(times * value)


def test_no_total_of_no_orders(spark):
    empty = spark.createDataFrame([], order_file.SCHEMA)
    assert order_file.build_reports(empty)["total_sales"].first()[0] == Decimal(0)
