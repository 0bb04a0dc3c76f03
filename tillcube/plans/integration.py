"""Several sources to one fact table, with duplicates, conflicts and counts reported."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.contract import COLUMNS
from tillcube.operators import multiset
from tillcube.operators.align import Source, rows_per_source, stack_sources
from tillcube.operators.cleaning import RULES, clean, counters
from tillcube.operators.dedup import duplicate_key_text, duplicate_members, price_conflicts
from tillcube.operators.numbering import number_rows
from tillcube.operators.reports import ranked
from tillcube.plans.etl import control_totals, fact_lines

INTEGRATED = RULES["integrated"]


def _by_rank(sources: Sequence[Source], attribute: str) -> Column:
    """The attribute of the source that ``source_rank`` points to; the list is short and known."""
    return F.element_at(F.array(*[F.lit(getattr(source, attribute)) for source in sources]), F.col("source_rank"))


def contract_lines(sources: Sequence[Source]) -> DataFrame:
    """Typed lines of all sources without lineage, for jobs that do not tell sources apart."""
    return stack_sources(sources, fill_missing=False).select(*COLUMNS)


def integrated_lines(sources: Sequence[Source], stacked: DataFrame | None = None) -> DataFrame:
    """Cleaned lines of all sources; of equal lines the one of the earliest source is kept.

    ``stacked`` is the sources' union where the caller has it already.
    """
    return with_lineage(clean(stack_sources(sources) if stacked is None else stacked, INTEGRATED), sources)


def with_lineage(lines: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Where the source that ``source_rank`` points to came from."""
    named = {"source_system": "system", "source_sheet": "sheet", "source_name": "name"}
    return lines.withColumns({column: _by_rank(sources, attribute) for column, attribute in named.items()})


def duplicates(stacked: DataFrame, across_sources: bool = False) -> DataFrame:
    """All lines whose business columns occur more than once (or in more than one source)."""
    valid = clean(stacked, replace(INTEGRATED, drop_duplicates=False))
    found = duplicate_members(valid, COLUMNS, "source_rank", across_sources)
    return found.withColumn("duplicate_business_key", duplicate_key_text(COLUMNS))


def listed_duplicates(rows: DataFrame, sources: Sequence[Source], across_sources: bool = False) -> DataFrame:
    """The same from distinct lines (see :mod:`tillcube.operators.multiset`)."""
    found = with_lineage(multiset.repeated(rows, INTEGRATED, across_sources), sources)
    return found.withColumn("duplicate_business_key", duplicate_key_text(COLUMNS))


def integrate(sources: Sequence[Source]) -> dict[str, DataFrame]:
    """``fact_sales`` and the reports about it.

    The distinct lines of all sources are written once and answer what is kept, what the counters say and what is listed as
    a duplicate; whole lines are shuffled for them, and then once more in the order of their numbers.
    """
    rows = multiset.collapse(stack_sources(sources), INTEGRATED, len(sources))
    facts = fact_lines(with_lineage(multiset.kept(rows, INTEGRATED), sources)).select(
        "invoice_no",
        "stock_code",
        "customer_id",
        "invoice_date",
        "year",
        "month",
        "day",
        "quantity",
        "unit_price",
        "revenue",
        "line_count",
        "country",
        "source_system",
        "source_sheet",
        "source_name",
        "description",
    )
    # Distinct lines may differ in nothing but their description, so that no two of these rows are equal.
    facts = number_rows(facts, "fact_sales_id", facts.columns).drop("description")
    return {
        "fact_sales": facts,
        "quality_report": counters(rows, INTEGRATED),
        "duplicates": listed_duplicates(rows, sources),
        "price_conflicts": price_conflicts(facts),
        "sales_by_country": ranked(control_totals(facts, "country"), "revenue", "country"),
        "sales_by_month": control_totals(facts, "year", "month").orderBy("year", "month"),
        "source_rows_count": rows_per_source(facts).orderBy("source_system", "source_sheet"),
    }
