"""Text to typed values; text that does not parse becomes null and never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcube.contract import CONTRACT

# Fixed value: the slash form of retail files, such as 12/1/10 8:26 (month, day, two-digit year).
SLASH_DATE = r"^\s*(\d{1,2})/(\d{1,2})/YEAR\s+(\d{1,2}:\d{2}(?::\d{2})?)\s*$"
# Two-digit years from 69 on lie in the last century.
LAST_CENTURY = r"(69|[7-9]\d)"
THIS_CENTURY = r"([0-6]\d)"
FULL_YEAR = r"(\d{4})"


def as_timestamp(text: Column) -> Column:
    """Parse the slash form or ISO text to a timestamp without time zone.

    The slash form is rewritten to ISO text, because format-driven parsing yields an instant that
    depends on the session time zone.
    """
    text = text.cast("string")
    for year, prefix in ((LAST_CENTURY, "19"), (THIS_CENTURY, "20"), (FULL_YEAR, "")):
        text = F.regexp_replace(text, SLASH_DATE.replace("YEAR", year), prefix + "$3-$1-$2 $4")
    return text.try_cast("timestamp_ntz")


def as_price(text: Column) -> Column:
    return text.try_cast(CONTRACT["unit_price"])


def as_quantity(text: Column) -> Column:
    """Parse a quantity, whole or not."""
    return text.try_cast(CONTRACT["quantity"])


def as_identifier(text: Column) -> Column:
    """Parse a numeric id written with or without decimals."""
    return text.try_cast("decimal(24,4)").try_cast("bigint")
