"""Bringing sources with different headers to the invoice-line contract."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.contract import COLUMNS, CONTRACT, HEADER_SPELLINGS, LINEAGE
from tillcube.functions.typing import as_identifier, as_price, as_quantity, as_timestamp


@dataclass(frozen=True)
class Source:
    """One part of the input: its lines as read, and where they come from."""

    lines: DataFrame
    system: str
    sheet: str
    name: str


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def rename_headers(df: DataFrame) -> DataFrame:
    """Rename every known header spelling to its contract name; other columns keep theirs."""
    df = trim_headers(df)
    names = [HEADER_SPELLINGS.get(re.sub("[^a-z0-9]", "", name.lower()), name) for name in df.columns]
    doubled = sorted({name for name in names if names.count(name) > 1})
    if doubled:
        raise ValueError(f"several headers stand for: {', '.join(doubled)}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Sequence[str] = COLUMNS) -> DataFrame:
    """Fail before any job runs when a column is missing; the error lists all of them."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def add_missing_columns(df: DataFrame) -> DataFrame:
    missing = {
        name: F.lit(None).cast(spark_type) for name, spark_type in CONTRACT.items() if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def align(df: DataFrame, keep: Sequence[str] = (), fill_missing: bool = False) -> DataFrame:
    """Rename, check (or add) and project to the contract's columns and order, plus ``keep``."""
    df = rename_headers(df)
    df = add_missing_columns(df) if fill_missing else require_columns(df)
    return df.select(*COLUMNS, *keep)


def typed(lines: DataFrame) -> DataFrame:
    """Give the contract columns their types; columns that have them already are left alone."""
    present = dict(lines.dtypes)
    wrong = [name for name, want in CONTRACT.items() if present[name] != want]
    return lines.withColumns({name: _parsed(name) for name in wrong})


def _parsed(name: str) -> Column:
    parse = {"quantity": as_quantity, "invoice_date": as_timestamp, "unit_price": as_price, "customer_id": as_identifier}
    return parse[name](F.col(name)) if name in parse else F.col(name).cast(CONTRACT[name])


def unparsed_values(lines: DataFrame) -> DataFrame:
    """Per contract column the values that are there but do not parse, and those that have more places than the
    contract keeps, from aligned lines not yet typed.

    Typing makes the first null, and the rules then drop their lines; it rounds the others. This report tells how many.
    """
    found = []
    for name, kind in CONTRACT.items():
        text = F.trim(F.col(name).cast("string"))
        rounded = text.try_cast("decimal(38,18)") != _parsed(name) if kind.startswith("decimal") else F.lit(False)
        unparsed = F.count_if((text != "") & _parsed(name).isNull())
        found.append(F.struct(F.lit(name), unparsed, F.count_if(rounded)))
    counted = lines.agg(F.array(*found).alias("_found"))
    return counted.select(F.inline("_found").alias("column_name", "unparsed_values", "rounded_values"))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all frames by column name; a column that a frame lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def stack_sources(sources: Sequence[Source], fill_missing: bool = True) -> DataFrame:
    """Typed lines of all sources with lineage; ``source_rank`` is the position in the list."""
    frames = []
    for rank, source in enumerate(sources, start=1):
        lines = typed(align(source.lines, fill_missing=fill_missing))
        values = (rank, source.system, source.sheet, source.name)
        frames.append(lines.withColumns({name: F.lit(value) for name, value in zip(LINEAGE, values)}))
    return stack(frames)


def rows_per_source(lines: DataFrame) -> DataFrame:
    return lines.groupBy("source_system", "source_sheet").agg(F.count("*").alias("rows_count"))
