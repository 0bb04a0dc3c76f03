"""Distinct lines with their copies: what is read from them, and how often whole lines move."""

import random
import re
from collections import Counter
from decimal import Decimal

from compare import executed_plans
from retail import line, lines, plain

from tillcube.operators import cleaning, multiset
from tillcube.operators.align import Source, stack_sources
from tillcube.operators.cleaning import RULES
from tillcube.operators.numbering import RUN, number_rows
from tillcube.plans import etl, integration


def drawn(seed, count):
    draw = random.Random(seed)
    return [
        line(
            invoice_no=draw.choice(["1", " 1", "2", "C3", "c4", None]),
            quantity=draw.choice([1, 1, -1, None]),
            unit_price=draw.choice([Decimal(1), Decimal(0), Decimal(-1)]),
            customer_id=draw.choice([7, 7, None]),
            description=draw.choice(["lamp", None]),
        )
        for _ in range(count)
    ]


def sources(spark):
    parts = [lines(spark, *drawn(seed, 150)) for seed in range(3)]
    return [Source(part, f"system {at}", "s", f"file {at}") for at, part in enumerate(parts)]


def test_counters_funnel_and_kept_lines_are_those_of_the_lines(spark):
    stacked = stack_sources(sources(spark))
    for name in ("integrated", "basic", "star", "analysis", "keep_all"):
        rows = multiset.collapse(stacked, RULES[name], 3)
        assert plain(cleaning.counters(rows, RULES[name])) == plain(cleaning.quality_counters(stacked, RULES[name]))
        assert plain(cleaning.funnel(rows, RULES[name])) == plain(cleaning.removal_funnel(stacked, RULES[name]))
        if RULES[name].drop_duplicates:
            cleaned = cleaning.clean(stacked, RULES[name])
            assert plain(multiset.kept(rows, RULES[name]), *cleaned.columns) == plain(cleaned)


def test_lines_of_one_source(spark):
    table = lines(spark, *drawn(5, 200))
    rows = multiset.collapse(table, RULES["basic"])
    assert plain(cleaning.counters(rows, RULES["basic"])) == plain(cleaning.quality_counters(table, RULES["basic"]))
    assert plain(multiset.kept(rows, RULES["basic"])) == plain(cleaning.clean(table, RULES["basic"]))
    nothing = multiset.collapse(table.limit(0), RULES["basic"])
    assert multiset.kept(nothing, RULES["basic"]).isEmpty()
    assert cleaning.counters(nothing, RULES["basic"]).first().rows_before == 0


def test_listed_duplicates_are_those_found_by_joining(spark):
    found = sources(spark)
    stacked = stack_sources(found)
    rows = multiset.collapse(stacked, integration.INTEGRATED, len(found))
    for across in (False, True):
        expected = integration.duplicates(stacked, across)
        listed = integration.listed_duplicates(rows, found, across).select(*expected.columns)
        assert plain(listed) == plain(expected)
        assert not expected.isEmpty()


def line_shuffles(plans):
    """Exchanges of whole lines by hash: those whose keys have the invoice and the price."""
    exchanged = []
    for plan in plans:
        exchanged += re.findall(r"hashpartitioning\(([^)]*unit_price[^)]*)\)", plan)
    return [keys for keys in exchanged if "invoice_no" in keys and "stock_code" in keys and "quantity" in keys]


def test_whole_lines_are_shuffled_once(spark):
    table = lines(spark, *drawn(5, 200))
    built, plans = executed_plans(spark, lambda: [df.collect() for df in etl.build_fact(table).values()])
    assert len(set(line_shuffles(plans))) == 1 and len(built) == 4
    found = sources(spark)
    built, plans = executed_plans(spark, lambda: [df.collect() for df in integration.integrate(found).values()])
    assert len(set(line_shuffles(plans))) == 1 and len(built) == 7


def test_numbers_of_equal_rows_depend_on_the_rows_alone(spark):
    draw = random.Random(8)
    rows = [(draw.choice(["a", "b", None]), draw.randrange(3)) for _ in range(500)] + [("hot", 1)] * (2 * RUN + 5)
    runs = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v int").repartition(7 * seed)
        runs.append(sorted((row.n, row.k, row.v) for row in number_rows(df, "n", ["k"], repeated=True).collect()))
    assert runs[0] == runs[1] and [n for n, _, _ in runs[0]] == list(range(1, len(rows) + 1))
    ordered = sorted(rows, key=lambda row: (row[0] is None, row[0] or "", row[1]))
    assert [(k, v) for _, k, v in runs[0]] == ordered
    assert Counter(rows) == Counter((k, v) for _, k, v in runs[0])
