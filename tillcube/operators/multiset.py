"""Lines as a multiset: each distinct line once, with its copies and the sources they came from.

Removing duplicates, the quality counters, the removal funnel and the list of duplicates all ask how often a line occurs and
where. One aggregate answers that, and its copies collapse before they are shuffled; it is written once, and everything
else reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.contract import LINEAGE
from tillcube.operators.cleaning import Rules, before_rules, fill_defaults, identity, kept_by
from tillcube.operators.numbering import expanded
from tillcube.sources.shared import materialize

# ``repeats``: copies that repeat a line of their own source.
COUNTS = ("copies", "repeats", "by_source")


def collapse(lines: DataFrame, rules: Rules, sources: int = 0) -> DataFrame:
    """Distinct lines, as the rules see them, with ``copies``, ``repeats`` and, of so many ``sources``, ``by_source`` (copies
    per ``source_rank``) and the lowest ``source_rank``."""
    lines = before_rules(lines, rules)
    names = identity(lines)
    found = [F.count_if(F.col("source_rank") == rank) for rank in range(1, sources + 1)]
    counted = lines.groupBy(*names).agg(F.count("*").alias("copies"), F.array(*found).cast("array<bigint>").alias("by_source"))
    if not sources:
        rows = counted.drop("by_source").withColumn("repeats", F.col("copies") - 1)
    else:
        present = F.transform("by_source", lambda copies: copies > 0)
        rows = counted.withColumns(
            {
                "repeats": F.col("copies") - F.size(F.filter("by_source", lambda copies: copies > 0)),
                "source_rank": F.array_position(present, F.lit(True)).cast("int"),
            }
        )
    return materialize(rows, "distinct_lines")


def kept(rows: DataFrame, rules: Rules) -> DataFrame:
    """The lines that the rules keep, each once, of the first source that has it."""
    found = kept_by(rows, rules).drop(*COUNTS)
    return fill_defaults(found) if rules.defaults == "last" else found


def repeated(rows: DataFrame, rules: Rules, across_sources: bool = False) -> DataFrame:
    """Every copy of lines that the rules keep and that occur more than once, or in more than one source, each with its
    ``source_rank``. A row of any number of copies is read as one and written copy by copy."""
    several = F.size(F.filter("by_source", lambda copies: copies > 0)) > 1 if across_sources else F.col("copies") > 1
    names = [name for name in rows.columns if name not in (*COUNTS, *LINEAGE)]
    found = kept_by(rows, rules).where(several)
    places = found.select(*names, F.posexplode("by_source").alias("_at", "_copies")).where(F.col("_copies") > 0)
    ranked = places.withColumn("source_rank", F.col("_at") + 1)
    return expanded(ranked, [*names, "source_rank"])
