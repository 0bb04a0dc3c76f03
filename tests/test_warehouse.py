"""Warehouse jobs on a customer who moves, sells nothing twice, and returns things."""

from datetime import datetime
from decimal import Decimal

import pytest
from retail import line, lines, plain

from tillcube.plans import etl, normalized, olap_pack, sales_pack, star, star_history
from tillcube.sources import sinks


def at(day, hour=9):
    return datetime(2011, 3, day, hour)


ROWS = [
    line(invoice_no="1", invoice_date=at(1), country="France", quantity=2),
    line(invoice_no="1", invoice_date=at(1), country="France", stock_code="B", description="cup"),
    line(invoice_no="2", invoice_date=at(2), country="Spain", quantity=4),
    line(invoice_no="3", invoice_date=at(3), country="France"),
    line(invoice_no="C4", invoice_date=at(3), country="France", quantity=-3),
    line(invoice_no="5", invoice_date=at(4), country="Spain", customer_id=None, description=None),
    line(invoice_no="6", invoice_date=at(4), country="France", customer_id=8, stock_code="B", description="mug"),
    line(invoice_no="7", invoice_date=at(4), country="France", customer_id=8, stock_code="B", description="cup"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return lines(spark, *ROWS)


def test_star_keeps_every_line_once(raw):
    tables = star.build_star(raw)
    facts = tables["fact_sales"].collect()
    assert sorted(row.sales_fact_id for row in facts) == list(range(1, len(ROWS) + 1))
    assert all(None not in row for row in facts)
    assert plain(tables["dim_customer"], "customer_business_key", "customer_id_source") == [
        ("7", 7),
        ("7", 7),
        ("8", 8),
        ("UNKNOWN_Spain", None),
    ]
    assert plain(tables["dim_product"]) == [(1, "A", "lamp"), (2, "B", "cup")]
    assert plain(star.sales_by_country(tables), "country_name", "net_sales", "gross_sales", "returns", "transaction_lines") == [
        ("France", 10.5, 15.0, -4.5, 6),
        ("Spain", 9.0, 9.0, 0.0, 2),
    ]
    assert plain(star.sales_by_month(tables), "period", "transaction_lines") == [("2011-03", 8)]


def test_customer_moves_there_and_back(raw):
    tables = star_history.build_star_history(raw)
    versions = plain(tables["dim_customer"], "customer_id", "country_name", "valid_from", "valid_to", "current_flag")
    assert versions == [
        (7, "France", at(1), at(2), False),
        (7, "France", at(3), None, True),
        (7, "Spain", at(2), at(3), False),
        (8, "France", at(4), None, True),
    ]
    facts = tables["fact_sales"]
    assert facts.count() == 6
    assert all(None not in row for row in facts.collect())
    key = {(row.customer_id, row.valid_from): row.customer_key for row in tables["dim_customer"].collect()}
    used = facts.join(tables["dim_invoice"], "invoice_key").select("invoice_no", "customer_key").distinct()
    assert plain(used) == sorted(
        [
            ("1", key[7, at(1)]),
            ("2", key[7, at(2)]),
            ("3", key[7, at(3)]),
            ("6", key[8, at(4)]),
            ("7", key[8, at(4)]),
        ]
    )
    assert plain(tables["dim_invoice"], "invoice_no", "invoice_hour")[0] == ("1", 9)
    assert plain(star_history.sales_by_country(tables), "country_name", "revenue", "lines") == [
        ("France", 15.0, 5),
        ("Spain", 6.0, 1),
    ]
    assert sum(row[1] for row in plain(star_history.sales_by_product(tables), "stock_code", "revenue")) == 21.0


def test_two_countries_at_one_moment_lose_no_fact(spark):
    rows = [line(country="Spain"), line(country="France"), line(invoice_no="2", invoice_date=at(9))]
    facts = star_history.build_star_history(lines(spark, *rows))["fact_sales"]
    assert facts.where("customer_key is not null").count() == 3


def test_entities(raw, folder, spark):
    tables = normalized.normalize(raw)
    assert plain(tables["country"]) == [(1, "France"), (2, "Spain")]
    assert tables["invoice_line"].count() == len(ROWS)
    assert tables["invoice"].count() == 7
    assert plain(tables["invoice"].where("is_cancelled"), "invoice_no") == [("C4",)]
    assert tables["invoice_line"].where("is_return").count() == 1
    sinks.write_warehouse(tables, folder)
    stored = sinks.read_warehouse(spark, folder, list(tables))
    assert {name: table.count() for name, table in stored.items()} == {
        "country": 2,
        "customer": 4,
        "product": 2,
        "invoice": 7,
        "invoice_line": 8,
    }


def test_first_header_of_an_invoice(spark):
    rows = [line(invoice_date=at(2)), line(invoice_date=at(1), country="Spain")]
    _, entities = prepared = normalized.build_entities(lines(spark, *rows))
    invoice = normalized.invoices(*prepared).first()
    assert invoice.invoice_date == at(1)
    countries = {row.country_id: row.country_name for row in entities["country"].collect()}
    assert countries[invoice.country_id] == "Spain"


def test_load_agrees_with_its_controls(raw):
    tables = etl.build_fact(raw)
    revenue = sum(row.revenue for row in tables["fact_sales"].collect())
    for name in ("sales_by_country", "sales_by_month"):
        assert sum(row.revenue for row in tables[name].collect()) == revenue == Decimal("21")
    report = tables["quality_report"].first()
    assert (report.rows_after, report.cancelled_invoices, report.missing_customer_id) == (6, 1, 1)


def test_report_packs_agree(raw):
    olap = olap_pack.build_reports(raw, "France", 2011)
    sales = sales_pack.build_reports(raw)
    assert float(olap["rollup_year"].first().total_price) == 21.0
    assert plain(olap["pivot_country_year"]) == [("France", 15.0), ("Spain", 6.0)]
    assert plain(olap["slice_monthly"], "month", "total_price") == [(3, 15.0)]
    assert plain(olap["dice_monthly"], "month", "total_price") == [(3, 15.0)]
    products = plain(olap["top_products_by_country"], "country", "stock_code", "description", "total_price")
    assert products == [
        ("France", "A", "lamp", 6.0),
        ("France", "B", "cup", 6.0),
        ("France", "B", "mug", 3.0),
        ("Spain", "A", "lamp", 6.0),
    ]
    assert olap["heat_map"].count() == 2
    assert [row.country for row in olap["top_countries"].collect()] == ["France", "Spain"]
    assert plain(olap["best_month"], "year_month") == [("2011-03",)]
    summary = {row.metric: row.value for row in sales["customer_summary"].collect()}
    assert summary["number_of_customers"] == 2
    assert summary["average_revenue_per_customer"] == 10.5
    assert [row.customer_id for row in sales["top_customers"].collect()] == [7, 8]
    assert float(sales["country_ranking"].first().total_price) == 15.0
    assert float(sales["top_segment_share"].first()[0]) == pytest.approx(15 / 21 * 100)
