"""Cleaning rules, counters, funnel, duplicates."""

from datetime import datetime
from decimal import Decimal

import pytest
from retail import line, lines, plain

from tillcube.operators import cleaning, dedup
from tillcube.operators.cleaning import RULES
from tillcube.operators.align import Source, typed, unparsed_values
from tillcube.plans import integration


def kept(spark, rules, *rows):
    return sorted(row.invoice_no for row in cleaning.clean(lines(spark, *rows), RULES[rules]).collect())


BAD = [
    line(invoice_no="C1"),
    line(invoice_no="c2"),
    line(invoice_no="3", quantity=0),
    line(invoice_no="4", quantity=None),
    line(invoice_no="5", unit_price=Decimal(0)),
    line(invoice_no="6", unit_price=Decimal(-1)),
    line(invoice_no="7", customer_id=None),
    line(invoice_no="8", invoice_date=None),
    line(invoice_no="9"),
    line(invoice_no="9"),
]


@pytest.mark.parametrize(
    ("rules", "expected"),
    [
        ("keep_all", ["3", "4", "5", "6", "7", "8", "9", "9", "C1", "c2"]),
        ("prepare", ["3", "4", "5", "6", "7", "8", "9", "9", "C1", "c2"]),
        ("star", ["9", "c2"]),
        ("basic", ["5", "9", "c2"]),
        ("integrated", ["5", "9"]),
        ("olap", ["9", "c2"]),
        ("analysis", ["9", "c2"]),
        ("bench", ["9", "9", "C1", "c2"]),
    ],
)
def test_rule_sets(spark, rules, expected):
    assert kept(spark, rules, *BAD) == expected


def test_a_missing_invoice_number_is_not_cancelled(spark):
    assert cleaning.clean(lines(spark, line(invoice_no=None)), RULES["basic"]).count() == 1


def test_analysis_needs_a_country(spark):
    assert kept(spark, "analysis", line(country=None)) == []
    assert kept(spark, "star", line(country=None)) == ["1"]


def test_defaults_and_trimming(spark):
    cleaned = cleaning.clean(lines(spark, line(description=None, country=None, stock_code=" A ")), RULES["basic"])
    row = cleaned.first()
    assert (row.description, row.country, row.stock_code) == ("Unknown product", "Unknown country", "A")


def test_default_before_or_after_duplicates(spark):
    rows = [line(description=None), line(description="Unknown product")]
    assert kept(spark, "basic", *rows) == ["1"]
    assert kept(spark, "star", *rows) == ["1", "1"]


@pytest.mark.parametrize("rules", ["star", "basic", "integrated", "olap", "analysis", "bench"])
def test_counters_describe_the_cleaning(spark, rules):
    df = lines(spark, *BAD)
    report = cleaning.quality_counters(df, RULES[rules]).first()
    assert report.rows_before == len(BAD)
    assert report.rows_after == cleaning.clean(df, RULES[rules]).count()
    assert report.rows_before == report.rows_after + report.rows_removed
    assert report.duplicates_before_cleaning == 1
    assert (report.missing_customer_id, report.quantity_not_positive, report.unit_price_negative) == (1, 1, 1)


@pytest.mark.parametrize("rules", ["star", "basic", "olap", "analysis", "bench"])
def test_funnel_steps_add_up(spark, rules):
    df = lines(spark, *BAD)
    steps = {row.step: row.value for row in cleaning.removal_funnel(df, RULES[rules]).collect()}
    removed = sum(value for step, value in steps.items() if step.startswith("removed_"))
    assert steps["rows_before"] - removed == steps["rows_after"]
    cleaned = cleaning.with_value(cleaning.clean(df, RULES[rules]))
    assert steps["rows_after"] == cleaned.count()
    assert steps["total_value"] == float(cleaned.groupBy().sum("total_price").first()[0])


def test_counters_of_no_lines(spark):
    empty = lines(spark, line()).limit(0)
    report = cleaning.quality_counters(empty, RULES["basic"]).first()
    assert (report.rows_before, report.rows_after, report.duplicates_before_cleaning) == (0, 0, 0)
    steps = {row.step: row.value for row in cleaning.removal_funnel(empty, RULES["basic"]).collect()}
    assert set(steps.values()) == {0.0}


def sources(spark):
    early = [line(), line(invoice_no="2")]
    late = [line(), line(), line(invoice_no="3"), line(invoice_no="3", unit_price=Decimal(2))]
    return [
        Source(lines(spark, *early), "shop", "csv", "shop.csv"),
        Source(lines(spark, *late), "web", "sheet 1", "web"),
    ]


def test_the_first_source_wins(spark):
    found = integration.integrated_lines(sources(spark))
    assert plain(found, "invoice_no", "unit_price", "source_system", "source_sheet") == [
        ("1", 1.5, "shop", "csv"),
        ("2", 1.5, "shop", "csv"),
        ("3", 1.5, "web", "sheet 1"),
        ("3", 2.0, "web", "sheet 1"),
    ]


def test_integration_job(spark):
    tables = integration.integrate(sources(spark))
    facts = tables["fact_sales"].collect()
    assert sorted(row.fact_sales_id for row in facts) == [1, 2, 3, 4]
    assert plain(tables["source_rows_count"]) == [("shop", "csv", 2), ("web", "sheet 1", 2)]
    conflict = tables["price_conflicts"].first()
    assert (conflict.invoice_no, conflict.unique_prices, conflict.rows_count) == ("3", 2, 2)
    report = tables["quality_report"].first()
    assert (report.rows_before, report.duplicates_before_cleaning, report.rows_after) == (6, 1, 4)
    assert tables["duplicates"].count() == 3
    total = tables["sales_by_country"].first()
    assert (float(total.revenue), total.transaction_lines) == (13.0, 4)


def test_duplicates_within_and_across_sources(spark):
    rows = [line(), line(), line(invoice_no="2")]
    one = Source(lines(spark, *rows), "shop", "csv", "shop.csv")
    two = Source(lines(spark, line(invoice_no="2")), "web", "s", "web")
    stacked = integration.stack_sources([one, two])
    assert plain(integration.duplicates(stacked), "invoice_no") == [("1",), ("1",), ("2",), ("2",)]
    assert plain(integration.duplicates(stacked, across_sources=True), "invoice_no") == [("2",), ("2",)]


def test_duplicate_members_match_missing_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert plain(dedup.duplicate_members(df, ["a", "b"])) == [(None, 1), (None, 1)]
    assert dedup.duplicate_row_count(df).first()[0] == 1


def test_first_per_key(spark):
    rows = [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "w")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    assert plain(dedup.first_per_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 5, "w")]


def test_price_conflicts_ignore_unknown_customers(spark):
    rows = [line(customer_id=None), line(customer_id=None, unit_price=Decimal(9))]
    assert dedup.price_conflicts(lines(spark, *rows)).count() == 0


def test_moment_of_cleaned_line(spark):
    row = cleaning.clean(lines(spark, line()), RULES["star"]).first()
    assert row.invoice_date == datetime(2011, 1, 5, 8, 30)


def test_large_small_and_broken_numbers_are_kept(spark):
    """Every one of these lines is sound, and so is every rule set's verdict on it."""
    columns = "invoice_no string, stock_code string, description string, quantity string, invoice_date string, " \
        "unit_price string, customer_id string, country string"
    found = [("2.5", "1"), ("3000000000", "1"), ("1", "0.00004"), ("1", "12345678901.5"), ("2", "1.5")]
    rows = [(str(at), "A", "lamp", *numbers, "7", "France") for at, numbers in enumerate(found)]
    rows = [(*row[:4], "2011-01-05 08:30:00", *row[4:]) for row in rows]
    raw = spark.createDataFrame(rows, columns)
    for name in ("olap", "basic", "star", "analysis"):
        kept = cleaning.clean(typed(raw), RULES[name]).collect()
        assert sorted((row.quantity, row.unit_price) for row in kept) == sorted(
            (Decimal(quantity), Decimal(price)) for quantity, price in found
        )
    broken = raw.union(spark.createDataFrame([("9", "A", "x", "many", "soon", "", None, "France")], columns))
    counted = {row.column_name: row.unparsed_values for row in unparsed_values(broken).collect()}
    assert {name: count for name, count in counted.items() if count} == {"quantity": 1, "invoice_date": 1}
    fine = spark.createDataFrame([("9", "A", "x", "0.00001", "soon", "1.23456789", None, "France")], columns)
    rounded = {row.column_name: row.rounded_values for row in unparsed_values(raw.union(fine)).collect()}
    assert {name: count for name, count in rounded.items() if count} == {"quantity": 1, "unit_price": 1}
