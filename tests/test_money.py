"""Exact sums from whole units against Python's decimals."""

import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F
from retail import line, lines, plain

from tillcube.functions import measures, money
from tillcube.operators import cleaning, reports
from tillcube.plans import olap_pack

TYPES = "k int, quantity decimal(16,4), unit_price decimal(18,6)"


def valued(spark, rows):
    df = spark.createDataFrame(rows, TYPES)
    df = df.withColumn("value", measures.line_value(F.col("quantity"), F.col("unit_price")))
    return money.with_lanes(df, "value")


def rows(seed, count):
    draw = random.Random(seed)
    quantity = [Decimal(0), Decimal("0.0001"), Decimal("-80995"), Decimal("999999999999.9999"), Decimal("-2.5"), None]
    price = [Decimal("0.000001"), Decimal("38970"), Decimal("999999999999.999999"), Decimal("-0.5"), Decimal("1.25"), None]
    found = [(draw.randrange(4), draw.choice(quantity), draw.choice(price)) for _ in range(count)]
    return [*found, (9, None, None)]


@pytest.mark.parametrize("seed", range(4))
def test_sums_of_any_size_are_exact(spark, seed):
    data = rows(seed, 300)
    df = valued(spark, data)
    keep = {"net": lambda x: x is not None, "gross": lambda x: x > 0, "back": lambda x: x < 0}
    found = df.groupBy("k").agg(
        money.exact_sum(df, "value").alias("net"),
        money.exact_sum_where(df, "value", lambda x: x > 0).alias("gross"),
        money.exact_sum_where(df, "value", lambda x: x < 0).alias("back"),
        money.exact_sum(df, "quantity").alias("quantity"),
        money.exact_sum(df, "value", F.lit(3).cast("bigint")).alias("thrice"),
    )
    assert dict(found.dtypes)["net"] == "decimal(38,10)" and dict(found.dtypes)["quantity"] == "decimal(26,4)"
    with localcontext() as context:
        context.prec = 60
        for row in found.collect():
            own = [(q, p) for k, q, p in data if k == row.k]
            values = [q * p for q, p in own if q is not None and p is not None]
            for name, wanted in keep.items():
                assert row[name] == sum((x for x in values if wanted(x)), Decimal(0))
            assert row.thrice == 3 * sum(values, Decimal(0))
            assert row.quantity == sum((q for q, _ in own if q is not None), Decimal(0))


def test_units_past_one_number_of_64_bits_add_up(spark):
    """Each value fits 64 bits and their sum does not."""
    df = valued(spark, [(1, Decimal("900000"), Decimal("1000"))] * 400)
    assert df.where("_value_units is null").isEmpty()
    assert df.groupBy().agg(money.exact_sum(df, "value")).first()[0] == 400 * 900_000_000


def test_overflow_raises(spark):
    huge = Decimal("999999999999.9999"), Decimal("999999999999.999999")
    df = valued(spark, [(1, *huge)] * 120)
    with pytest.raises(Exception, match="OVERFLOW|out of range|OUT_OF_RANGE|cannot be represented"):
        df.groupBy().agg(money.exact_sum(df, "value")).collect()


def test_the_same_without_lanes_and_with(spark):
    df = valued(spark, [(k, q, p) for k, q, p in rows(9, 200) if q is None or abs(q) < 10**6])
    bare = money.without_lanes(df)
    assert bare.columns == ["k", "quantity", "unit_price", "value"] and not money.has_lanes(bare, "value")
    assert plain(reports.totals_by(df, ["k"], ["value"])) == plain(reports.totals_by(bare, ["k"], ["value"]))


def test_no_decimal_is_summed_per_line(spark):
    sales = olap_pack.sales_lines(lines(spark, line(), line(quantity=-1)))
    plan = reports.totals_by(sales, ["country"], olap_pack.MEASURES)._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(_total_price_wide" in plan and "sum(total_price" not in plan and "sum(quantity" not in plan


def test_the_funnel_keeps_every_place(spark):
    small = Decimal("0.000001")
    copies = [line(quantity=Decimal("1.0001"), unit_price=small)] * 3
    wide = [line(invoice_no="2", quantity=Decimal("999999999999.0001"), unit_price=Decimal("1000.000001"))] * 2
    rules = cleaning.Rules(positive_quantity=True)
    collapsed = cleaning._collapsed(lines(spark, *copies, *wide), rules)
    kept = money.with_lanes(cleaning.with_value(collapsed, "value"), "value")
    found = kept.groupBy().agg(money.exact_sum(kept, "value", F.col("copies"))).first()[0]
    with localcontext() as context:
        context.prec = 60
        assert found == sum((row[3] * row[5] for row in (*copies, *wide)), Decimal(0))
    steps = {row.step: row.value for row in cleaning.removal_funnel(lines(spark, *copies), rules).collect()}
    assert steps["total_value"] == pytest.approx(3 * 1.0001e-6, rel=1e-12)
