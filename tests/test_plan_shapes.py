"""Pushdown, pruning and reuse in the plans; test_queries checks the shape of every query."""

import re

import pytest
from compare import executed_plans

from __spark_entry__ import queries
from tillcube.operators.cleaning import RULES, clean
from tillcube.sources.sample_tables import load_table, retail_lines
from tillcube.sources.shared import new_path

QUERIES = queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small):
    text = plan(load_table(spark, small, "orders").where("o_totalprice > 1000").select("o_custkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in text
    path = new_path(spark, "lines")
    retail_lines(spark, small).write.parquet(path)
    stored = clean(spark.read.parquet(path), RULES["star"])._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", stored).group(1)
    assert re.search(r"GreaterThan\(quantity,0(\.0+)?\)", pushed) and "IsNotNull(customer_id)" in pushed
    lines = clean(retail_lines(spark, small), RULES["star"]).groupBy("country").count()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", lines._jdf.queryExecution().executedPlan().toString())
    assert not any("l_tax" in schema or "p_brand" in schema for schema in schemas)


def test_preparation_report_moves_no_line(spark, small):
    text = plan(QUERIES["preparation_report"](spark, small)).split("== Initial Plan ==")[0]
    assert "hashpartitioning(invoice_no" not in text and text.count("SinglePartition") == 1


def test_counters_scan_each_table_once(spark, small):
    text = plan(QUERIES["quality_report"](spark, small)).split("== Initial Plan ==")[0]
    assert text.count("lineitem.parquet") == 1


@pytest.mark.parametrize("name", ["kimball_fact", "star_fact"])
def test_facts_are_numbered_without_being_counted_first(spark, small, name):
    _, plans = executed_plans(spark, lambda: QUERIES[name](spark, small).count())
    assert any("rangepartitioning" in plan and "_tie" in plan for plan in plans)
    assert not any("_copies" in plan for plan in plans)


def test_measures_are_not_moved_to_their_month(spark, small):
    _, plans = executed_plans(spark, lambda: QUERIES["warehouse_sink_counts"](spark, small).count())
    moved = [text for plan in plans for text in re.findall(r"Exchange\nInput \[\d+\]: ([^\n]*)\nArguments: [^\n]*REBALANCE", plan)]
    assert moved and not any("sales_amount" in text or "is_return" in text for text in moved)


def test_lines_meet_their_orders_with_their_own_columns(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(retail_lines(spark, small)).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in text.splitlines() if "hashpartitioning(l_orderkey" in line]
    assert joins and "l_returnflag" not in text.split("hashpartitioning(l_orderkey")[0]
