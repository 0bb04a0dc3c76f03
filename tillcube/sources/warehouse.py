"""Writing a set of tables and reports so that it can be run again.

A set is written below ``sets/<id>`` and counts only once the file ``current`` names it, which is the last thing
written. A run that is killed leaves a set that nothing names; the next run writes its own set, names it, and removes what
is named no more. So a reader finds one whole set at any time, and running a job twice gives one set.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tillcube.sources.shared import delete, folder_names, read_text, rename, write_text
from tillcube.sources.sinks import write_csv, write_warehouse

SETS, CURRENT, NEXT = "sets", "current.json", "current.next"


@dataclass(frozen=True)
class StoredSet:
    """Where the tables (Parquet) and reports (CSV) of a set lie, and the rows that each table was written with."""

    folder: str
    tables: dict[str, int] = field(default_factory=dict)
    reports: tuple[str, ...] = ()

    def table_path(self, name: str) -> str:
        return f"{self.folder}/tables/{name}"

    def report_path(self, name: str) -> str:
        return f"{self.folder}/reports/{name}"


def _sets(output: str) -> str:
    return f"{output.rstrip('/')}/{SETS}"


def write_set(
    spark: SparkSession,
    output: str,
    tables: Mapping[str, DataFrame],
    reports: Mapping[str, DataFrame] | None = None,
    layout: Mapping[str, Sequence[str]] | None = None,
) -> StoredSet:
    """Write all tables and reports, then make them the current set of ``output`` and remove the sets before it.

    A table that is written is read back for its number of rows, so that a set with a table that cannot be read is never
    named.
    """
    before = folder_names(spark, _sets(output))
    identity = uuid.uuid4().hex
    folder = f"{_sets(output)}/{identity}"
    write_warehouse(tables, f"{folder}/tables", layout)
    for name, report in (reports or {}).items():
        write_csv(report, f"{folder}/reports/{name}")
    counts = {name: spark.read.parquet(f"{folder}/tables/{name}").count() for name in tables}
    manifest = {"set": identity, "tables": counts, "reports": sorted(reports or {})}
    # The name appears at once and whole: the file is written beside it and renamed.
    write_text(spark, f"{output}/{NEXT}", json.dumps(manifest))
    rename(spark, f"{output}/{NEXT}", f"{output}/{CURRENT}")
    for name in before:
        delete(spark, f"{_sets(output)}/{name}")
    return StoredSet(folder, counts, tuple(manifest["reports"]))


def current_set(spark: SparkSession, output: str) -> StoredSet:
    """The set that ``output`` names; an error where no run has ended yet."""
    # Where a file cannot be renamed onto another, a run that is killed in between leaves the new name alone.
    for name in (CURRENT, NEXT):
        try:
            manifest = json.loads(read_text(spark, f"{output}/{name}") or "")
        except ValueError:
            continue
        return StoredSet(f"{_sets(output)}/{manifest['set']}", manifest["tables"], tuple(manifest["reports"]))
    raise FileNotFoundError(f"no set has been written to {output}")
