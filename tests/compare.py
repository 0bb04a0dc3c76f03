"""Running a registered query in Spark and in DuckDB and comparing the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

# The sample tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"create view {table} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda position: names[position])
    plain = [tuple(_plain(row[position]) for position in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((value is None, str(type(value)), str(value)) for value in row))


def spark_rows(df):
    return sorted(df.columns), sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted(names), sorted_rows(names, cursor.fetchall())


def executed_plans(spark, action):
    """What ``action`` returns, and the plan of every query that ran meanwhile, those behind writes too."""
    store = spark._jsparkSession.sharedState().statusStore()

    def executions():
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.executionsList()
        return {found.apply(at).executionId(): found.apply(at) for at in range(found.size())}

    before = max(executions(), default=-1)
    result = action()
    after = {number: found for number, found in executions().items() if number > before}
    # Spark keeps a number of executions and forgets the oldest; their numbers have no gaps.
    assert sorted(after) == list(range(before + 1, before + 1 + len(after))), "a plan is lost"
    return result, [found.physicalPlanDescription() for found in after.values()]
