"""Versioned history and the join to the version valid at a moment."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from retail import plain

from tillcube.operators.history import (
    _in_ranges,
    attach_version,
    attach_version_by_moment,
    version_history,
    version_history_with_moments,
)

START = datetime(2011, 1, 30)


def day(number):
    return START + timedelta(days=number)


def table(spark, rows):
    moments = [(key, day(number), value) for key, number, value in rows]
    return spark.createDataFrame(moments, "key int, at timestamp_ntz, value string")


def history(spark, rows):
    return version_history(table(spark, rows), ["key"], "value", "at")


@pytest.fixture(params=[True, False], ids=["one range", "many ranges"])
def ranges(spark, request):
    """Small tables fill one range unless Spark is told not to join small ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def one_by_one(rows):
    """The history built in plain Python."""
    moments = {}
    for key, number, value in rows:
        if key is not None and number is not None:
            known = moments.setdefault(key, {})
            known[number] = min(known.get(number, value), value)
    versions = []
    for key, known in moments.items():
        starts = []
        for number in sorted(known):
            if not starts or starts[-1][1] != known[number]:
                starts.append((number, known[number]))
        for place, (number, value) in enumerate(starts):
            following = day(starts[place + 1][0]) if place + 1 < len(starts) else None
            versions.append((key, value, day(number), following, following is None))
    return sorted(versions, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_there_and_back(spark, ranges):
    rows = [(1, 0, "A"), (1, 1, "A"), (1, 2, "B"), (1, 40, "B"), (1, 41, "A"), (2, 5, "C")]
    assert plain(history(spark, rows)) == [
        (1, "A", day(0), day(2), False),
        (1, "A", day(41), None, True),
        (1, "B", day(2), day(41), False),
        (2, "C", day(5), None, True),
    ]


def test_values_at_one_moment_are_one_value(spark):
    assert plain(history(spark, [(1, 0, "B"), (1, 0, "A"), (1, 3, "A")])) == [(1, "A", day(0), None, True)]


def test_rows_without_key_are_left_out(spark):
    assert plain(history(spark, [(None, 0, "A"), (1, 0, "A")])) == [(1, "A", day(0), None, True)]


def test_missing_value_is_a_value(spark, ranges):
    versions = plain(history(spark, [(1, 0, None), (1, 1, None), (1, 2, "A"), (1, 70, None)]))
    assert [(row[1], row[2]) for row in versions] == [("A", day(2)), (None, day(0)), (None, day(70))]


@pytest.mark.parametrize("values", ["A", "ABC"])
def test_against_plain_python(spark, ranges, values):
    generator = random.Random(len(values))
    rows = [
        (generator.choice([1, 1, 1, 2, 3]), generator.randrange(0, 900), generator.choice(values))
        for _ in range(400)
    ]
    assert plain(history(spark, rows)) == one_by_one(rows)


def test_attach_version_edges(spark, ranges):
    versions = spark.createDataFrame(
        [(1, day(0), day(10), "a"), (1, day(10), day(20), "b"), (1, day(50), None, "c")],
        "key int, valid_from timestamp_ntz, valid_to timestamp_ntz, name string",
    )
    wanted = {-1: None, 0: "a", 9: "a", 10: "b", 19: "b", 20: None, 49: None, 50: "c", 900: "c"}
    facts = spark.createDataFrame([(1, day(n), n) for n in wanted] + [(2, day(0), 1000), (None, day(0), 1001)],
                                  "key int, at timestamp_ntz, id int")
    found = attach_version(facts, versions, ["key"], "at", ["name"])
    assert found.columns == ["key", "at", "id", "name"]
    assert {row.id: row.name for row in found.collect()} == {**wanted, 1000: None, 1001: None}


def test_attach_version_keeps_every_fact(spark, ranges):
    generator = random.Random(7)
    rows = [(generator.choice([1, 1, 2]), generator.randrange(0, 500), generator.choice("AB")) for _ in range(200)]
    versions = history(spark, rows)
    facts = table(spark, rows + rows[:50])
    facts = facts.withColumnRenamed("value", "own")
    columns = ["value", "valid_from", "valid_to"]
    result = attach_version(facts, versions, ["key"], "at", columns).collect()
    assert len(result) == 250
    for row in result:
        assert row.valid_from <= row.at and (row.valid_to is None or row.at < row.valid_to)


def test_versions_of_a_composite_key_may_leave_gaps(spark):
    rows = [(1, 0, "A"), (1, 5, "B"), (1, 9, "A")]
    events = table(spark, rows)
    found = attach_version(events, history(spark, rows), ["key", "value"], "at", ["valid_from"])
    assert plain(found, "value", "at", "valid_from") == [
        ("A", day(0), day(0)),
        ("A", day(9), day(9)),
        ("B", day(5), day(5)),
    ]


def test_one_key_and_one_day_are_spread_over_tasks(spark):
    """All rows of one key, a microsecond apart: no task may get them all."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    step = F.col("id").cast("int")
    rows = spark.range(20_000).select(
        F.lit(1).alias("key"),
        F.timestamp_micros(F.lit(1_300_000_000_000_000) + F.col("id")).cast("timestamp_ntz").alias("at"),
        F.when(step % 5_000 < 2_500, "A").otherwise("B").alias("value"),
    )
    sizes = _in_ranges(rows, ["key"], "at", "spread").groupBy("_range").count().collect()
    versions = version_history(rows, ["key"], "value", "at")
    assert versions.count() == 8
    found = attach_version(rows.drop("value"), versions, ["key"], "at", ["value"])
    assert found.exceptAll(rows.select(found.columns)).isEmpty()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert len(sizes) >= 4 and max(row["count"] for row in sizes) <= 10_000


def test_columns_the_facts_have_are_refused(spark):
    rows = [(1, 0, "A")]
    with pytest.raises(ValueError, match="value"):
        attach_version(table(spark, rows), history(spark, rows), ["key"], "at", ["value"])


def several(seed, keys=4, count=60):
    draw = random.Random(seed)
    return [(draw.choice([*range(keys), None]), draw.randrange(80), draw.choice(["A", "B", None])) for _ in range(count)]


@pytest.mark.parametrize("seed", range(3))
def test_moments_find_the_version_that_holds(spark, ranges, seed):
    rows = [*several(seed), *((9, at, "A" if at % 30 < 15 else "B") for at in range(60))]
    df = table(spark, rows)
    versions, moments = version_history_with_moments(df, ["key"], "value", "at")
    assert plain(versions) == plain(version_history(df, ["key"], "value", "at"))
    facts = df.select("key", "at").withColumn("n", F.monotonically_increasing_id())
    columns = ["value", "valid_from", "current_flag"]
    swept = attach_version(facts, versions, ["key"], "at", columns)
    assert plain(attach_version_by_moment(facts, moments, versions, ["key"], "at", columns)) == plain(swept)
    with pytest.raises(ValueError, match="already have"):
        attach_version_by_moment(df, moments, versions, ["key"], "at", ["value"])


@pytest.mark.parametrize("seed", range(3))
def test_versions_and_moments_are_numbered_along_the_layout(spark, ranges, seed):
    rows = [*several(seed), *((9, at, "A" if at % 30 < 15 else "B") for at in range(60))]
    df = table(spark, rows)
    versions, moments = version_history_with_moments(df, ["key"], "value", "at", "number")
    found = plain(version_history(df, ["key"], "value", "at"), "key", "valid_from", "value", "valid_to")
    found.sort(key=lambda row: row[:2])
    numbered = sorted(tuple(row) for row in versions.select("number", "key", "valid_from", "value", "valid_to").collect())
    assert numbered == [(place, *row) for place, row in enumerate(found, 1)]
    by_start = {(row[1], row[2]): row[0] for row in numbered}
    assert all(row.number == by_start[row.key, row.valid_from] for row in moments.collect())
    facts = attach_version_by_moment(df, moments, versions, ["key"], "at", ["number"])
    assert facts.count() == len(rows)
    assert "valid_from" not in facts._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]


def test_moments_also_agree_in_the_tracked_value(spark):
    df = table(spark, [(1, 0, "B"), (1, 0, "A"), (1, 1, "B")])
    versions, moments = version_history_with_moments(df, ["key"], "value", "at")
    found = attach_version_by_moment(df, moments, versions, ["key"], "at", ["valid_from"], ["value"])
    assert plain(found, "at", "value", "valid_from") == [
        (day(0), "A", day(0)), (day(0), "B", None), (day(1), "B", day(1)),
    ]


def versions_table(spark, rows):
    schema = "key int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    moments = [(key, name, day(a), None if b is None else day(b)) for key, name, a, b in rows]
    return spark.createDataFrame(moments, schema)


@pytest.mark.parametrize("seed", range(12))
def test_overlapping_versions_raise_and_others_match_the_interval_join(spark, ranges, seed):
    draw = random.Random(seed)
    rows = []
    for key in range(3):
        at = 0
        for number in range(draw.randrange(1, 9)):
            length = draw.randrange(1, 6)
            rows.append((key, f"{key}-{number}", at, at + length))
            at += length + draw.choice([0, 0, 3])
    if seed % 2:
        key, _, a, b = draw.choice(rows)
        # One that begins inside another, at its start, or before others that it never ends for.
        rows.append(draw.choice([(key, "more", b - 1, b + 1), (key, "more", a, None), (key, "more", a - 5, None)]))
    versions = versions_table(spark, rows)
    facts = spark.createDataFrame([(key, day(at)) for key in range(4) for at in range(-2, 45)], "key int, at timestamp_ntz")
    joined = attach_version(facts, versions, ["key"], "at", ["name"])
    if seed % 2:
        with pytest.raises(Exception, match="versions overlap for key"):
            joined.collect()
        return
    inside = (facts["at"] >= versions["valid_from"]) & (facts["at"] < versions["valid_to"])
    plainly = facts.join(versions, (facts["key"] == versions["key"]) & inside, "left")
    assert plain(joined) == plain(plainly.select(facts["key"], facts["at"], "name"))


def test_versions_that_touch_or_are_empty_do_not_overlap(spark, ranges):
    rows = [(1, "a", 0, 5), (1, "b", 5, 5), (1, "c", 5, 9), (1, "d", 9, None), (2, "e", 0, None)]
    facts = spark.createDataFrame([(1, day(5)), (1, day(9)), (2, day(7))], "key int, at timestamp_ntz")
    found = attach_version(facts, versions_table(spark, rows), ["key"], "at", ["name"])
    assert plain(found, "name") == [("c",), ("d",), ("e",)]
