"""Flags and measures of an invoice line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcube.contract import UNKNOWN_CUSTOMER_PREFIX

# Fixed value: the letter that marks a cancelled invoice.
CANCELLED_PREFIX = "C"


def is_cancelled(invoice_no: Column, any_case: bool = False) -> Column:
    """True for a cancelled invoice; a missing number counts as not cancelled."""
    number = F.upper(invoice_no) if any_case else invoice_no
    return F.coalesce(number.startswith(CANCELLED_PREFIX), F.lit(False))


def is_return(quantity: Column) -> Column:
    return quantity < 0


def line_value(quantity: Column, unit_price: Column) -> Column:
    """Exact value of a line; decimal in, decimal out."""
    return quantity * unit_price


def gross_part(value: Column) -> Column:
    return F.when(value > 0, value).otherwise(F.lit(0))


def return_part(value: Column) -> Column:
    return F.when(value < 0, value).otherwise(F.lit(0))


def business_key(customer_id: Column, country: Column) -> Column:
    """The customer's id as text, or one key per country for unknown customers."""
    unknown = F.concat(F.lit(UNKNOWN_CUSTOMER_PREFIX), country)
    return F.when(customer_id.isNull(), unknown).otherwise(customer_id.cast("string"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a double, 0 where the denominator is 0."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    return F.when(bottom != 0, F.try_divide(top, bottom)).otherwise(F.lit(0.0))


def total(value: Column) -> Column:
    """Sum in which no value at all adds up to 0."""
    return F.coalesce(F.sum(value), F.lit(0))


def segment(value: Column, low: Column, high: Column, labels: tuple[str, str, str]) -> Column:
    """Label a value by two thresholds; the upper one is tested first and both are inclusive."""
    top, middle, bottom = labels
    return F.when(value >= high, top).when(value <= low, bottom).otherwise(middle)
