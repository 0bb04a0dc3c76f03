"""Tables in buckets of a key, and sketches that roll up."""

import pytest
from pyspark.sql import functions as F
from retail import plain

from tillcube.operators import reports, sketches
from tillcube.plans import methods
from tillcube.sources import shared
from tillcube.sources.sample_tables import retail_lines


@pytest.fixture(scope="module")
def keyed(spark, small):
    return methods.pre_keyed(methods.bench_lines(retail_lines(spark, small)))


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_groupings_by_customer_shuffle_nothing(spark, small, keyed):
    lines = methods.bench_lines(retail_lines(spark, small))
    groupings = {
        "sums": lambda df: reports.totals_by(df, ["customer_id"], ["total_price"]),
        "months": lambda df: reports.totals_by(df, ["customer_id", "year_month"], ["total_price"]),
        "invoices": lambda df: reports.distinct_by(df, "customer_id", "invoice_no", "invoices"),
    }
    for grouping in groupings.values():
        assert exchanges(grouping(keyed)) == 0
        assert plain(grouping(keyed)) == plain(grouping(lines))
    assert exchanges(reports.totals_by(keyed, ["country"], ["total_price"])) > 0
    both = groupings["sums"](keyed).join(groupings["invoices"](keyed), "customer_id")
    assert "Exchange hashpartitioning" not in both._jdf.queryExecution().executedPlan().toString()


def test_tables_in_buckets_are_removed_with_their_job(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_folder", lambda _: str(tmp_path))
    with shared.job(spark):
        table = shared.materialize_by_key(spark.range(50).withColumn("k", F.col("id") % 7), "buckets", "k", 3)
        assert table.groupBy("k").count().count() == 7
        names = [found.name for found in spark.catalog.listTables() if found.name.startswith("buckets_")]
        assert len(names) == 1 and len(list(tmp_path.iterdir())) == 1
    assert not spark.catalog.tableExists(names[0]) and not list(tmp_path.iterdir())


def test_sketches_roll_up_within_their_error(spark):
    rows = spark.range(400_000).select(
        (F.col("id") % 2).alias("country"), (F.col("id") % 12).alias("month"), (F.col("id") % 90_001).alias("invoice"),
        F.lit(1).alias("hot"),
    )
    fine = sketches.distinct_sketches(rows, ["country", "month", "hot"], "invoice")
    assert fine.count() == 12
    for keys in (["country"], ["month"], ["hot"]):
        exact = rows.groupBy(*keys).agg(F.count_distinct("invoice").alias("exact"))
        both = sketches.rolled_up(fine, keys, "estimate").join(exact, keys)
        assert both.where(~sketches.within_error(F.col("estimate"), F.col("exact"))).isEmpty()
    missing = spark.createDataFrame([(None, "a"), ("k", None), ("k", "a"), ("k", "a")], "k string, v string")
    assert plain(sketches.rolled_up(sketches.distinct_sketches(missing, ["k"], "v"), ["k"], "n")) == [("k", 1)]
    assert sketches.distinct_sketches(missing.limit(0), ["k"], "v").isEmpty()
