"""Every registered query against its SQL, on the smallest tables, and the shape of its plan."""

import re

import pytest
from compare import connect, duckdb_rows, executed_plans, spark_rows

from __spark_entry__ import entry, oracle_sql, queries
from tillcube.plans.catalog import QUERIES
from tillcube.plans.catalog_sql import ORACLE_SQL as SQL
from tillcube.sources.shared import materialize


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def check_shape(plan):
    """No whole tables paired, no Python per row, no large table ordered in one task."""
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert unwanted not in plan
    for first in re.findall(r"windowspecdefinition\(([^,]*),", plan):
        # A window without partitions starts with its order; only written partitions are so counted.
        assert " ASC" not in first and " DESC" not in first or first.startswith("_partition#")


def test_the_check_sees_what_is_written_on_the_way(spark):
    def planted():
        return materialize(spark.range(3).crossJoin(spark.range(2).toDF("other")), "planted")

    _, plans = executed_plans(spark, planted)
    with pytest.raises(AssertionError):
        for plan in plans:
            check_shape(plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, small, connection, name):
    (names, rows), plans = executed_plans(spark, lambda: spark_rows(QUERIES[name](spark, small)))
    assert plans
    for plan in plans:
        check_shape(plan)
    expected_names, expected = duckdb_rows(connection, SQL[name])
    assert names == expected_names
    assert rows == expected
    assert rows


def test_entry_points_hold_every_query():
    assert set(QUERIES) <= set(queries())
    assert set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
