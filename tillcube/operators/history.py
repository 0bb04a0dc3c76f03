"""Versioned (type 2) history of an attribute, and finding the version valid at a moment.

Both look along the time line of a key with windows. Rows are dealt out by range of key and moment and
written with the number of their range; windows run inside one range (and key), while what crosses the
border between ranges travels through one summary row per range (and key). So a key may own any share
of the table and any number of rows in any span of time: it is spread over as many ranges as it fills.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcube.functions.filters import with_known
from tillcube.sources.shared import materialize


def _in_ranges(line: DataFrame, key: Sequence[str], at: str, label: str) -> DataFrame:
    """Rows with ``_range``, which ascends with key and moment; rows of one moment share it."""
    dealt = line.repartitionByRange(*key, at)
    return materialize(dealt.withColumn("_range", F.spark_partition_id()), label)


def one_value_per_moment(df: DataFrame, key: Sequence[str], tracked: str, at: str) -> DataFrame:
    """The tracked value per key and moment; of several at one moment the lowest stands."""
    # Copies of a value go first, which needs no sorting; of what is left there is little to compare.
    known = with_known(df, [*key, at]).select(*key, at, tracked).distinct()
    return known.groupBy(*key, at).agg(F.min(tracked).alias(tracked))


def _runs(moments: DataFrame, group: Sequence[str], tracked: str, at: str) -> DataFrame:
    """First row of each run of equal values inside a group, with the start of the next run.

    ``_first`` marks the run that opens the group.
    """
    line = Window.partitionBy(*group).orderBy(at)
    first = F.row_number().over(line) == 1
    runs = moments.withColumns({"_first": first, "_previous": F.lag(tracked).over(line)})
    runs = runs.where(F.col("_first") | ~F.col("_previous").eqNullSafe(F.col(tracked)))
    return runs.withColumn("valid_to", F.lead(at).over(line)).drop("_previous")


def _joined_runs(moments: DataFrame, key: Sequence[str], tracked: str, at: str) -> DataFrame:
    """Runs found range by range, then joined where a range goes on with the value that the range
    before ended with."""
    group = [*key, "_range"]
    runs = _runs(moments, group, tracked, at)
    value = F.struct(F.col(tracked).alias("value"))
    ranges = runs.groupBy(*group).agg(
        F.min_by(value, at).alias("_head"),
        F.max_by(value, at).alias("_tail"),
        F.min(at).alias("_head_at"),
        F.min(F.when(~F.col("_first"), F.col(at))).alias("_second_at"),
    )
    backwards = Window.partitionBy(*key).orderBy(F.col("_range").desc())
    goes_on = F.lead("_tail").over(backwards).eqNullSafe(F.col("_head"))
    ranges = ranges.withColumn("_goes_on", goes_on)
    opened = F.when(F.col("_goes_on"), F.col("_second_at")).otherwise(F.col("_head_at"))
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    borders = ranges.withColumn("_opened", opened).select(
        *group, "_goes_on", F.last("_opened", ignorenulls=True).over(later).alias("_next_opened")
    )
    joined = runs.join(borders, group).where(~(F.col("_first") & F.col("_goes_on")))
    return joined.withColumn("valid_to", F.coalesce("valid_to", "_next_opened"))


def version_history(df: DataFrame, key: Sequence[str], tracked: str, at: str) -> DataFrame:
    """One row per run of equal tracked values, with a half-open validity interval.

    Columns: key, tracked, valid_from, valid_to (null while current), current_flag. Intervals of a
    key touch without gaps or overlaps, and none is empty.
    """
    moments = _in_ranges(one_value_per_moment(df, key, tracked, at), key, at, "moments")
    return _versions(moments, key, tracked, at)


def _versions(moments: DataFrame, key: Sequence[str], tracked: str, at: str) -> DataFrame:
    versions = _joined_runs(moments, key, tracked, at).select(
        *key, tracked, F.col(at).alias("valid_from"), "valid_to"
    )
    return versions.withColumn("current_flag", F.col("valid_to").isNull())


def version_history_with_moments(
    df: DataFrame, key: Sequence[str], tracked: str, at: str, number: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The history, and each of its moments with the ``valid_from`` of the version that holds then.

    Both read one layout of the time line by ranges, so facts that the history was built from find their versions
    without being dealt out and swept again. As the layout follows key and moment, so do its versions: with ``number``
    both get a column of that name in front, 1..n in the order of the versions, which costs no sort of its own.
    """
    moments = _in_ranges(one_value_per_moment(df, key, tracked, at), key, at, "moments")
    marked, ranges = _marked_starts(moments, key, tracked, at)
    placed = marked.join(F.broadcast(ranges), F.col("_range") == F.col("_partition"))
    opens = (F.col("_place") == 1) & ~F.col("_goes_on")
    begun = F.col("_begun") + F.when(F.col("_goes_on"), 0).otherwise(1)
    placed = placed.withColumns(
        {
            "_starts": F.col("_start") | opens,
            "_begin": F.coalesce("_begin", F.when(F.col("_goes_on"), F.col("_carried")).otherwise(F.col("_head_at"))),
            "_version": F.col("_offset") + begun,
        }
    )
    numbered = [F.col("_version").alias(number)] if number else []
    # The next start ends a version if it is of the same key: looked for in the range, then in later ones.
    name = F.struct(*key)
    line = Window.partitionBy("_range").orderBy(*key, at)
    starts = placed.where("_starts").withColumn("_next", F.lead(F.struct(*key, F.col(at).alias("_at"))).over(line))
    starts = starts.withColumn("_next", F.coalesce("_next", "_next_start"))
    same = F.struct(*[F.col(f"_next.{column}").alias(column) for column in key]) == name
    versions = starts.select(
        *numbered,
        *key,
        tracked,
        F.col(at).alias("valid_from"),
        F.when(F.col("_next").isNotNull() & same, F.col("_next._at")).alias("valid_to"),
    )
    versions = versions.withColumn("current_flag", F.col("valid_to").isNull())
    return versions, placed.select(*numbered, *key, at, tracked, F.col("_begin").alias("valid_from"))


def _marked_starts(
    moments: DataFrame, key: Sequence[str], tracked: str, at: str
) -> tuple[DataFrame, DataFrame]:
    """Every moment with the starts of versions in its range up to it, the range's first row left out, and one row per
    range that tells what crosses its borders.

    Ranges follow key and moment, so only the first row of a range depends on what the range before ended with.
    """
    line = Window.partitionBy("_range").orderBy(*key, at)
    value = F.struct(*key, F.col(tracked).alias("_value"))
    marked = moments.withColumns({"_place": F.row_number().over(line), "_before": F.lag(value).over(line)})
    start = (F.col("_place") > 1) & ~F.col("_before").eqNullSafe(value)
    marked = marked.withColumn("_start", start).drop("_before")
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumns(
        {
            "_begun": F.count(F.when(F.col("_start"), 1)).over(so_far),
            "_begin": F.last(F.when(F.col("_start"), F.col(at)), ignorenulls=True).over(so_far),
        }
    )
    marked = materialize(marked, "marked_moments")
    first = F.col("_place") == 1
    opening = F.struct(*key, F.col(at).alias("_at"))
    ranges = marked.groupBy(F.col("_range").alias("_partition")).agg(
        F.max(F.when(first, value)).alias("_head"),
        F.max(F.when(first, F.col(at))).alias("_head_at"),
        F.max(F.when(first, opening)).alias("_opening"),
        F.max_by(value, "_place").alias("_tail"),
        F.max_by("_begin", "_place").alias("_last_begin"),
        F.min(F.when(F.col("_start"), opening)).alias("_first_start"),
        F.max("_begun").alias("_inside"),
    )
    order = Window.orderBy("_partition")
    goes_on = F.coalesce(F.lag("_tail").over(order).eqNullSafe(F.col("_head")), F.lit(False))
    ranges = ranges.withColumn("_goes_on", goes_on)
    opened = F.when(~F.col("_goes_on"), F.col("_opening"))
    latest = F.coalesce("_last_begin", F.when(~F.col("_goes_on"), F.col("_head_at")))
    ranges = ranges.withColumns(
        {
            "_latest": latest,
            "_earliest": F.coalesce(opened, "_first_start"),
            "_all": F.col("_inside") + F.when(F.col("_goes_on"), 0).otherwise(1),
        }
    )
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    return marked, ranges.select(
        "_partition",
        "_goes_on",
        "_head_at",
        F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_offset"),
        F.last("_latest", ignorenulls=True).over(earlier).alias("_carried"),
        F.first("_earliest", ignorenulls=True).over(later).alias("_next_start"),
    )


def attach_version_by_moment(
    facts: DataFrame,
    moments: DataFrame,
    versions: DataFrame,
    key: Sequence[str],
    at: str,
    columns: Sequence[str],
    same: Sequence[str] = (),
) -> DataFrame:
    """Left-join to each fact the ``columns`` of the version valid at its moment, for facts whose moments the history was
    built from (``moments``, as :func:`version_history_with_moments` gives them).

    Only facts that also agree with the moment in the columns ``same`` (such as the tracked value) find a version.
    Columns that the moments have themselves (such as the number of their version) are taken from there.
    """
    clash = set(columns) & set(facts.columns)
    if clash:
        raise ValueError(f"the facts already have columns {sorted(clash)}")
    own = [name for name in columns if name in moments.columns]
    others = [name for name in columns if name not in own]
    found = moments.withColumns({f"_found_{name}": F.col(name) for name in own})
    if others:
        wanted = versions.select(*key, "valid_from", *[F.col(name).alias(f"_found_{name}") for name in others])
        found = found.join(wanted, [*key, "valid_from"])
    names = [*key, at, *same]
    found = found.select(*[F.col(name).alias(f"_{name}") for name in names], *[f"_found_{name}" for name in columns])
    joined = facts.join(found, [F.col(name) == F.col(f"_{name}") for name in names], "left")
    return joined.select(*facts.columns, *[F.col(f"_found_{name}").alias(name) for name in columns])


def _latest(line: DataFrame, key: Sequence[str], at: str, value: str) -> DataFrame:
    """Replace ``value`` by the key's latest non-null one at or before each row's moment: looked for in
    the row's range, then carried from an earlier one."""
    group = [*key, "_range"]
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(at)))
    ranges = line.groupBy(*group).agg(last.alias("_last"))
    earlier = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(*group, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    so_far = Window.partitionBy(*group).orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = line.withColumn(value, F.last(value, ignorenulls=True).over(so_far))
    return inside.join(carried, group).withColumn(value, F.coalesce(value, "_carried")).drop("_range", "_carried")


# After every moment: the end of a version that is still valid.
NEVER = "9999-12-31 23:59:59.999999"


def _without_overlaps(line: DataFrame, key: Sequence[str], at: str, version: str, until: str) -> DataFrame:
    """Raise an error where a version begins before one that began earlier in its key has ended.

    The latest end so far is looked for in the row's range, then carried from earlier ones.
    """
    group = [*key, "_range"]
    end = F.when(F.col(version).isNotNull(), F.coalesce(until, F.lit(NEVER).cast("timestamp_ntz")))
    line = line.withColumn("_end", end)
    earlier = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = line.groupBy(*group).agg(F.max("_end").alias("_range_end"))
    carried = ends.select(*group, F.max("_range_end").over(earlier).alias("_carried_end"))
    before = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    latest = F.greatest(F.max("_end").over(before), F.col("_carried_end"))
    joined = line.join(carried, group).withColumn("_latest_end", latest)
    named = F.concat_ws(", ", *[F.col(name).cast("string") for name in key])
    error = F.raise_error(F.concat(F.lit("versions overlap for key "), named, F.lit(" at "), F.col(at).cast("string")))
    overlaps = F.col(version).isNotNull() & (F.col("_latest_end") > F.col(at))
    checked = F.when(overlaps, error).otherwise(F.col(version))
    return joined.withColumn(version, checked).drop("_end", "_carried_end", "_latest_end")


def attach_version(
    facts: DataFrame, versions: DataFrame, key: Sequence[str], at: str, columns: Sequence[str]
) -> DataFrame:
    """Left-join to each fact the ``columns`` of the version valid at its moment.

    A version is valid from ``valid_from`` on and before ``valid_to`` (null: still valid). Versions of one key that
    overlap raise an error that names the key, for a fact would have several. The facts must not have the columns yet. The version is looked up
    once per distinct key and moment by sweeping both along the time line, so facts and versions of a
    key are never paired with each other, and the facts join on key and moment, which spreads a hot key
    over its moments.
    """
    clash = set(columns) & set(facts.columns)
    if clash:
        raise ValueError(f"the facts already have columns {sorted(clash)}")
    moments = with_known(facts, [*key, at]).select(*key, F.col(at).alias("_moment")).distinct()
    # A version that ends where it begins holds at no moment.
    lasting = versions.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
    starts = with_known(lasting, [*key, "valid_from"]).select(
        *key,
        F.col("valid_from").alias("_moment"),
        F.struct(F.col("valid_to").alias("_until"), *columns).alias("_version"),
    )
    line = moments.withColumn("_fact", F.lit(True)).unionByName(starts, allowMissingColumns=True)
    dealt = _in_ranges(line, key, "_moment", "time_line")
    checked = _without_overlaps(dealt, key, "_moment", "_version", "_version._until")
    found = _latest(checked, key, "_moment", "_version")
    until = F.col("_version._until")
    valid = F.col("_fact") & F.col("_version").isNotNull() & (until.isNull() | (F.col("_moment") < until))
    found = found.where(valid).select(
        *[F.col(name).alias(f"_{name}") for name in key], "_moment", *[f"_version.{name}" for name in columns]
    )
    same = [F.col(name) == F.col(f"_{name}") for name in key]
    joined = facts.join(found, [*same, F.col(at) == F.col("_moment")], "left")
    return joined.drop("_moment", *[f"_{name}" for name in key])
