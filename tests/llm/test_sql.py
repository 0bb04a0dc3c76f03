"""Queries that SQL can express against that SQL."""

import pytest
from compare import connect, duckdb_rows, spark_rows

from tillcube.llm.queries import QUERIES
from tillcube.llm.queries_sql import ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, small, name):
    expected = duckdb_rows(connect(small), ORACLE_SQL[name])
    assert spark_rows(QUERIES[name](spark, small)) == expected
