"""Cleaning rules, quality counters and the removal funnel.

One set of rules drives all three, so the reports always describe the cleaning that was done.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.contract import LINEAGE, UNKNOWN_COUNTRY, UNKNOWN_PRODUCT
from tillcube.functions import measures
from tillcube.functions.filters import all_known
from tillcube.functions.money import exact_sum, with_lanes
from tillcube.operators.dedup import count_copies, first_by_rank

TEXT_COLUMNS = ("invoice_no", "stock_code", "description", "country")


@dataclass(frozen=True)
class Rules:
    """Which lines a job keeps.

    ``cancelled`` is the treatment of cancelled invoices: "" keeps them, "exact" drops the upper
    case mark, "any_case" both. ``price`` is "", "positive" or "not_negative". ``defaults`` tells
    when missing descriptions and countries get their stand-in: "never", "first" (before equal
    rows are looked for) or "last".
    """

    required: tuple[str, ...] = ()
    cancelled: str = ""
    positive_quantity: bool = False
    price: str = ""
    drop_duplicates: bool = False
    trim: bool = False
    defaults: str = "never"


# The rule sets of the jobs.
MEASURED = ("customer_id", "invoice_date", "quantity", "unit_price")
RULES: dict[str, Rules] = {
    "keep_all": Rules(defaults="first"),
    "star": Rules(("customer_id", "invoice_date"), "exact", True, "positive", True, defaults="last"),
    "basic": Rules(("customer_id", "invoice_date"), "exact", True, "not_negative", True, True, "first"),
    "integrated": Rules(("customer_id", "invoice_date"), "any_case", True, "not_negative", True, True, "first"),
    "olap": Rules(MEASURED, "exact", True, "positive", True, defaults="first"),
    "analysis": Rules((*MEASURED, "country"), "exact", True, "positive", True),
    "prepare": Rules(),
    "bench": Rules(MEASURED, "", True, "positive", False),
}


def fill_defaults(lines: DataFrame) -> DataFrame:
    return lines.fillna({"description": UNKNOWN_PRODUCT, "country": UNKNOWN_COUNTRY})


def before_rules(lines: DataFrame, rules: Rules) -> DataFrame:
    if rules.trim:
        lines = lines.withColumns({name: F.trim(F.col(name)) for name in TEXT_COLUMNS})
    return fill_defaults(lines) if rules.defaults == "first" else lines


def _conditions(rules: Rules) -> Iterable[tuple[str, Column]]:
    """What a kept line meets, by the name of the rule it would break, in the order of the rules.

    The conditions are plain comparisons, which the optimizer pushes to the scan; null means broken.
    """
    if rules.required:
        yield "missing_key_data", all_known(rules.required)
    if rules.cancelled:
        number = F.upper("invoice_no") if rules.cancelled == "any_case" else F.col("invoice_no")
        yield "cancelled_invoice", number.isNull() | ~number.startswith(measures.CANCELLED_PREFIX)
    if rules.positive_quantity:
        yield "quantity_not_positive", F.col("quantity") > 0
    if rules.price:
        price = F.col("unit_price")
        yield "unit_price_rejected", price > 0 if rules.price == "positive" else price >= 0


def first_violation(rules: Rules) -> Column:
    """Name of the first rule that a line breaks, null for a line that is kept."""
    label = F.lit(None).cast("string")
    for name, condition in reversed(list(_conditions(rules))):
        label = F.when(F.coalesce(condition, F.lit(False)), label).otherwise(F.lit(name))
    return label


def identity(lines: DataFrame) -> list[str]:
    """The columns that make two lines the same: all but the lineage."""
    return [name for name in lines.columns if name not in LINEAGE]


def drop_duplicates(lines: DataFrame) -> DataFrame:
    """One line of each group of equal ones; of several sources the first one is kept."""
    if "source_rank" in lines.columns:
        return first_by_rank(lines, identity(lines), "source_rank")
    return lines.distinct()


def kept_by(lines: DataFrame, rules: Rules) -> DataFrame:
    """The lines that meet every condition of the rules."""
    for _, condition in _conditions(rules):
        lines = lines.where(condition)
    return lines


def clean(lines: DataFrame, rules: Rules) -> DataFrame:
    """Apply a rule set to typed lines.

    The filters need no shuffle and reach the scan; removing duplicates takes one shuffle, with
    equal lines collapsed before it. Of the lineage only ``source_rank`` outlives that step.
    """
    lines = kept_by(before_rules(lines, rules), rules)
    if rules.drop_duplicates:
        lines = drop_duplicates(lines)
    return fill_defaults(lines) if rules.defaults == "last" else lines


def with_value(lines: DataFrame, name: str = "total_price") -> DataFrame:
    return lines.withColumn(name, measures.line_value(F.col("quantity"), F.col("unit_price")))


def _rows_where(condition: Column, weight: str = "copies") -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint")


def _collapsed(lines: DataFrame, rules: Rules) -> DataFrame:
    """Distinct lines with ``copies`` and with ``repeats``, the copies that repeat a whole row.

    Whole rows include the lineage, duplicates for cleaning do not; with one source both agree and
    a single aggregate is enough.
    """
    lines = before_rules(lines, rules)
    rows = count_copies(lines)
    names = identity(lines)
    if len(names) == len(lines.columns):
        return rows.withColumn("repeats", F.col("copies") - 1)
    return rows.groupBy(*names).agg(
        F.sum("copies").alias("copies"), F.sum(F.col("copies") - 1).alias("repeats")
    )


def quality_counters(lines: DataFrame, rules: Rules) -> DataFrame:
    """All quality counters in one row, from one scan.

    The lines are first collapsed to distinct ones with their number of copies, which the
    duplicate counters need anyway; every other counter is a weighted sum over those.
    """
    return counters(_collapsed(lines, rules), rules)


def counters(collapsed: DataFrame, rules: Rules) -> DataFrame:
    """The quality counters of distinct lines with their ``copies`` and ``repeats``."""
    kept = first_violation(rules).isNull()
    any_case = rules.cancelled == "any_case"
    after = F.count_if(kept).cast("bigint") if rules.drop_duplicates else _rows_where(kept)
    report = collapsed.agg(
        _rows_where(F.lit(True)).alias("rows_before"),
        _rows_where(F.col("customer_id").isNull()).alias("missing_customer_id"),
        _rows_where(measures.is_cancelled(F.col("invoice_no"), any_case)).alias("cancelled_invoices"),
        _rows_where(F.col("quantity") <= 0).alias("quantity_not_positive"),
        _rows_where(F.col("unit_price") < 0).alias("unit_price_negative"),
        _rows_where(F.col("invoice_date").isNull()).alias("missing_invoice_date"),
        _rows_where(F.lit(True), "repeats").alias("duplicates_before_cleaning"),
        after.alias("rows_after"),
    )
    return report.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def preparation_report(lines: DataFrame, rules: Rules) -> DataFrame:
    """Lines before and after the rules, duplicates left alone: one scan, in which no line is moved."""
    kept = first_violation(rules).isNull()
    report = before_rules(lines, rules).agg(
        F.count("*").alias("rows_before"), F.count_if(kept).cast("bigint").alias("rows_after")
    )
    return report.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def removal_funnel(lines: DataFrame, rules: Rules) -> DataFrame:
    """Lines removed by each rule in turn, as (step, value) rows from one scan.

    Each line belongs to the first rule it breaks. Duplicates come last, among the kept lines. The
    last row is the total value of what remains.
    """
    return funnel(_collapsed(lines, rules), rules)


def funnel(collapsed: DataFrame, rules: Rules) -> DataFrame:
    """The removal funnel of distinct lines with their ``copies``."""
    collapsed = collapsed.withColumn("broken", first_violation(rules))
    kept = F.col("broken").isNull()
    collapsed = with_lanes(with_value(collapsed, "value"), "value")
    weight = F.lit(1).cast("bigint") if rules.drop_duplicates else F.col("copies")
    value = exact_sum(collapsed, "value", F.when(kept, weight))
    removed = [
        _rows_where(F.col("broken") == name).alias(f"removed_{name}") for name, _ in _conditions(rules)
    ]
    if rules.drop_duplicates:
        repeats = F.sum(F.when(kept, F.col("copies") - 1))
        removed.append(F.coalesce(repeats, F.lit(0)).alias("removed_duplicates"))
    counters = collapsed.agg(
        _rows_where(F.lit(True)).alias("rows_before"),
        *removed,
        F.coalesce(F.sum(F.when(kept, weight)), F.lit(0)).alias("rows_after"),
        value.alias("total_value"),
    )
    as_double = [F.col(name).cast("double").alias(name) for name in counters.columns]
    return counters.select(*as_double).unpivot([], counters.columns, "step", "value")
