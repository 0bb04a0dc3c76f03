"""Quality rules learned from labelled documents: an ordered list of conjunctions of thresholds.

Sequential covering: a rule for low quality is grown on two thirds of the labelled rows, one threshold at a
time, by the information it gains; its last thresholds are pruned while that helps on the other third; a rule that is
precise there joins the list, the rows it covers leave, and the next rule is grown. The list becomes an ordered
Spark conditional expression: the first rule that holds rejects, and a document that none covers is kept.

Counts of (threshold interval, label) come from Spark aggregates over all labelled rows; the driver sees one row per
interval, however many rows are labelled. Everything on the path of the documents is a built-in expression.

Defined cases: a null or empty text has no words and fails the base; without labelled rows of both kinds
no rule is learned; ties between thresholds go to the first statistic and the lowest threshold; rows without label or id
teach nothing; extra columns stay; an empty table gives no rows.
"""

from __future__ import annotations

from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.llm.statistics import SHARES, shares, with_statistics
from tillcube.llm.tables import ROW, packed, unpacked
from tillcube.sources.shared import materialize

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Candidate thresholds of a statistic: this many quantiles of either class.
QUANTILES = 32
MAX_RULES = 8
MAX_CONDITIONS = 4
# Least share of low quality among the rows that a rule covers in the pruning third.
MIN_PRECISION = 0.95
PRUNING_SHARE = 3


class Condition(NamedTuple):
    statistic: str
    at_least: bool
    threshold: float

    def holds(self, values: dict[str, Column]) -> Column:
        value = values[self.statistic]
        return value >= self.threshold if self.at_least else value < self.threshold


Rule = tuple[Condition, ...]


def conjunction(rule: Rule, values: dict[str, Column]) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.holds(values)
    return out


def verdict(rules: list[Rule], stats: Column) -> Column:
    """True for what is kept: the first rule that holds decides."""
    values = shares(stats)
    out = None
    for rule in rules:
        holds = conjunction(rule, values)
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``low`` (1 for low quality); a document with both labels is of low quality."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg((1 - F.min("quality")).cast("long").alias("low"))


def learn(known: DataFrame) -> list[Rule]:
    """Rules from rows with ``doc_id``, ``stats`` and ``low``."""
    values = shares(F.col("stats"))
    pruning = F.pmod(F.xxhash64("doc_id"), F.lit(PRUNING_SHARE)) == 0
    rows = known.select(*[values[name].alias(name) for name in SHARES], "low", pruning.alias("pruning"))
    rows = materialize(rows, "labelled_shares")
    thresholds = _thresholds(rows)
    places = [_interval(F.col(name), thresholds[name]) for name in SHARES]
    rows = materialize(rows.withColumn("bins", F.array(*places)), "labelled")
    names = {name: F.col(name) for name in SHARES}
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        rule = _prune(left.where("pruning"), _grow(left.where("not pruning"), thresholds))
        if not rule:
            break
        rules.append(rule)
        left = left.where(~conjunction(rule, names))
    return rules


def _interval(value: Column, thresholds: list[float]) -> Column:
    """How many of the thresholds the value reaches."""
    return F.size(F.filter(F.array(*[F.lit(x) for x in thresholds]), lambda threshold: threshold <= value))


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of each statistic over both classes."""
    steps = F.array(*[F.lit(at / QUANTILES) for at in range(QUANTILES + 1)])
    found = rows.groupBy("low").agg(*[F.percentile_approx(name, steps).alias(name) for name in SHARES]).collect()
    return {name: sorted({float(x) for row in found for x in row[name]}) or [0.0] for name in SHARES}


def _gain(low: int, good: int, all_low: int, all_good: int) -> float:
    """Information that a condition gains on the rows of low quality it leaves."""
    if not low:
        return 0.0
    return low * (log2(low / (low + good)) - log2(all_low / (all_low + all_good)))


def _grow(rows: DataFrame, thresholds: dict[str, list[float]]) -> Rule:
    """Add the threshold with the largest gain until only low quality is left."""
    names = {name: F.col(name) for name in SHARES}
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        intervals = rows.where(conjunction(rule, names)).select("low", F.posexplode("bins").alias("statistic", "bin"))
        counted = intervals.groupBy("statistic", "bin").agg(F.sum("low").alias("low"), F.count("*").alias("rows"))
        # At most (statistics x thresholds) rows.
        found = {(row["statistic"], row["bin"]): (row["low"], row["rows"] - row["low"]) for row in counted.collect()}
        best, best_gain = None, 1e-9
        for at, name in enumerate(SHARES):
            bins = [found.get((at, x), (0, 0)) for x in range(len(thresholds[name]) + 1)]
            all_low, all_good = (sum(x) for x in zip(*bins, strict=True))
            if not all_low or not all_good:
                continue
            under_low = under_good = 0
            for threshold, (low, good) in zip(thresholds[name], bins[:-1], strict=True):
                under_low, under_good = under_low + low, under_good + good
                over = _gain(all_low - under_low, all_good - under_good, all_low, all_good)
                under = _gain(under_low, under_good, all_low, all_good)
                for gain, at_least in ((over, True), (under, False)):
                    if gain > best_gain * (1 + 1e-9):
                        best, best_gain = Condition(name, at_least, threshold), gain
        if best is None:
            break
        rule = (*rule, best)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The prefix of the rule that does best on other rows; none if it is not precise there."""
    if not rule:
        return ()
    names = {name: F.col(name) for name in SHARES}
    prefixes = [rule[:length] for length in range(1, len(rule) + 1)]
    counts = []
    for at, prefix in enumerate(prefixes):
        holds = conjunction(prefix, names)
        counts += [F.count_if(holds & (F.col("low") == 1)).alias(f"low{at}"), F.count_if(holds).alias(f"all{at}")]
    found = rows.agg(*counts).first()

    def worth(at: int) -> float:
        low, every = found[f"low{at}"], found[f"all{at}"]
        return (2 * low - every) / every if every else -1.0

    best = max(range(len(prefixes)), key=worth)
    low, every = found[f"low{best}"], found[f"all{best}"]
    return prefixes[best] if low and low >= MIN_PRECISION * every else ()


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id``, counts, ``base_failed`` and ``kept`` of every row of ``statistics_of``."""
    return _decided(stats, rules).select("doc_id", "stats.*", "base_failed", "kept")


def _decided(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    failed = base_failed(F.col("stats"))
    return rows.withColumns({"base_failed": failed, "kept": ~failed & verdict(rules, F.col("stats"))})


def keep(docs: DataFrame, rules: list[Rule], text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns. No row is moved."""
    row = packed(docs)
    return unpacked(_decided(with_statistics(row, row[ROW][text_column], ROW), rules).where("kept"))
