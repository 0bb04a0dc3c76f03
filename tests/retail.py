"""Hand-made invoice lines."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from tillcube.contract import COLUMNS, CONTRACT

SCHEMA = ", ".join(f"{name} {spark_type}" for name, spark_type in CONTRACT.items())


def line(**values):
    """One line with sound values except for the given ones."""
    row = {
        "invoice_no": "1",
        "stock_code": "A",
        "description": "lamp",
        "quantity": 2,
        "invoice_date": datetime(2011, 1, 5, 8, 30),
        "unit_price": Decimal("1.5"),
        "customer_id": 7,
        "country": "France",
    }
    row.update(values)
    if isinstance(row["quantity"], int):
        row["quantity"] = Decimal(row["quantity"])
    return tuple(row[name] for name in COLUMNS)


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def plain(df, *columns):
    """Rows as a sorted list of tuples, decimals as floats."""
    chosen = df.select(*columns) if columns else df
    rows = [tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in chosen.collect()]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))
