"""Exact sums of decimals in whole numbers.

A decimal of many digits is an object per value. Line values and quantities are therefore added up as whole numbers of
their smallest unit, in lanes beside the decimal: ``_<name>_units`` holds the value where it fits 64 bits, ``_<name>_wide`` the
decimal where it does not. One sum of units could overflow on a large table, so their upper and lower bits are summed
apart, and the decimal is made once per group. Sums past what the result can hold raise an error, as all overflow does under
Spark's default (ANSI) arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Lower bits that are summed apart: enough rows for any table, and room for sums of a million times 2^63.
LOW_BITS = 20
# Digits of a sum of units, and of a sum of decimals.
SUM_DIGITS, MOST_DIGITS = 26, 38


def units_lane(name: str) -> str:
    return f"_{name}_units"


def wide_lane(name: str) -> str:
    return f"_{name}_wide"


def units(value: Column, scale: int) -> Column:
    """A decimal as a number of its smallest units; null where that takes more than 64 bits."""
    return (value * F.lit(10**scale)).try_cast("bigint")


def with_lanes(lines: DataFrame, value: str, quantity: str = "quantity", unit_price: str = "unit_price") -> DataFrame:
    """Add the lanes of ``value``, the product of quantity and price, and those of the quantity."""
    scales = {name: lines.schema[name].dataType.scale for name in (quantity, unit_price)}
    counted = units(F.col(quantity), scales[quantity])
    amount = F.try_multiply(counted, units(F.col(unit_price), scales[unit_price]))
    return lines.withColumns(
        {
            units_lane(value): amount,
            wide_lane(value): F.when(amount.isNull(), F.col(value)),
            units_lane(quantity): counted,
            wide_lane(quantity): F.when(counted.isNull(), F.col(quantity)),
        }
    )


def without_lanes(lines: DataFrame) -> DataFrame:
    """The lines as a reader expects them."""
    names = [lane(name) for name in lines.columns for lane in (units_lane, wide_lane)]
    return lines.drop(*names)


def has_lanes(df: DataFrame, name: str) -> bool:
    return units_lane(name) in df.columns and wide_lane(name) in df.columns


def _joined(high: Column, low: Column, wide: Column, scale: int) -> Column:
    """One decimal of the sums of upper bits, of lower bits and of wide values."""
    whole = F.coalesce(high, F.lit(0)).cast("decimal(19,0)") * F.lit(2**LOW_BITS) + F.coalesce(low, F.lit(0))
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(1)
    digits = MOST_DIGITS - 2
    narrow = (whole.cast(f"decimal({SUM_DIGITS},0)") * unit).cast(f"decimal({digits},{scale})")
    return narrow + F.coalesce(wide, F.lit(0)).cast(f"decimal({digits},{scale})")


def _total(df: DataFrame, name: str, counted: Column, wide: Column, weight: Column | None = None) -> Column:
    kind: DecimalType = df.schema[name].dataType
    high, low = F.shiftright(counted, LOW_BITS), counted.bitwiseAND(F.lit(2**LOW_BITS - 1))
    if weight is not None:
        high, low, wide = high * weight, low * weight, weighted(wide, weight)
    found = _joined(F.sum(high), F.sum(low), F.sum(wide), kind.scale)
    return found.cast(f"decimal({min(MOST_DIGITS, kind.precision + 10)},{kind.scale})")


def weighted(value: Column, weight: Column) -> Column:
    """A decimal of ten places times a whole number, exactly: multiplied at once, places would be lost."""
    whole = F.floor(value)
    places = (value - whole).cast("decimal(10,10)") * weight.cast("decimal(20,0)")
    # 26 digits before the point and ten after it add up without losing any.
    return (whole.cast("decimal(25,0)") * weight.cast("decimal(13,0)")).cast("decimal(26,0)") + places.cast("decimal(36,10)")


def exact_sum(df: DataFrame, name: str, weight: Column | None = None) -> Column:
    """Sum of a column, from its lanes where the frame has them; 0 where there is no value at all. ``weight`` is a whole
    number that each value counts for."""
    if has_lanes(df, name):
        return _total(df, name, F.col(units_lane(name)), F.col(wide_lane(name)), weight)
    value = F.col(name) if weight is None else F.col(name) * weight
    return F.coalesce(F.sum(value), F.lit(0))


def exact_sum_where(df: DataFrame, name: str, keep: Callable[[Column], Column]) -> Column:
    """The same over values that meet a condition on their sign."""
    counted, wide = F.col(units_lane(name)), F.col(wide_lane(name))
    return _total(df, name, F.when(keep(counted), counted), F.when(keep(wide), wide))
