"""Calendar parts of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def period(at: Column) -> Column:
    """Month as text, such as 2011-01."""
    return F.date_format(at, "yyyy-MM")


def period_of(year: Column, month: Column) -> Column:
    """Month as text from its parts, the month padded to two digits."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def weekday(at: Column) -> Column:
    return F.date_format(at, "EEEE")


def with_calendar(df: DataFrame, at: str, *parts: str) -> DataFrame:
    """Add the named parts: date, year, quarter, month, day, weekday, hour, year_month."""
    moment = F.col(at)
    known = {
        "date": F.to_date(moment),
        "year": F.year(moment),
        "quarter": F.quarter(moment),
        "month": F.month(moment),
        "day": F.dayofmonth(moment),
        "weekday": weekday(moment),
        "hour": F.hour(moment),
        "year_month": period(moment),
    }
    return df.withColumns({name: known[name] for name in parts})
