"""Quality classifier: a sparse ensemble of rules.

A random forest over text statistics gives candidate rules: the path to every node is a conjunction of
thresholds. A logistic regression with a lasso penalty weighs them and sets most weights to zero. What is left becomes one
Spark column expression, so that scoring is part of the scan. Forest and regression are Spark ML's and learn from all
labelled rows.

Defined cases: a null or empty text has counts of zero and the score of that; without rows of both labels the score is the
share of label 1 (one half without any); a document with both labels counts as label 0; rows without label or id teach
nothing; an empty table gives no rows.
"""

from __future__ import annotations

from math import log
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.llm.quality_rules import Condition, Rule, conjunction
from tillcube.llm.statistics import SHARES, shares, statistics_of, with_statistics
from tillcube.llm.tables import ROW, packed, unpacked
from tillcube.sources.shared import materialize

TREES = 12
DEPTH = 3
PENALTY = 0.001
ROUNDS = 40
SEED = 7
ACCEPTED = 0.5


class Ensemble(NamedTuple):
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        """Probability of label 1 as one expression."""
        values = shares(stats)
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(conjunction(rule, values), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _paths(node, so_far: Rule = ()) -> list[Rule]:
    """Conjunctions that lead to the nodes below a node of a Spark ML tree."""
    if node.getClass().getSimpleName() == "LeafNode":
        return []
    split = node.split()
    name, threshold = SHARES[split.featureIndex()], float(split.threshold())
    out = []
    # Spark ML goes left where the value is not above the threshold.
    for child, at_least in ((node.leftChild(), False), (node.rightChild(), True)):
        rule = (*so_far, Condition(name, at_least, threshold))
        out += [rule, *_paths(child, rule)]
    return out


def fit(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """Learn from rows with ``stats`` and ``label`` (0 or 1)."""
    values = shares(F.col("stats"))
    rows = materialize(
        labelled.select(*[values[name].alias(name) for name in SHARES], F.col("label").cast("double").alias("label")),
        "labelled",
    )
    ones, every = rows.agg(F.sum("label"), F.count("*")).first()
    if not every or ones in (0, every):
        share = (ones or 0) / every if every else 0.5
        return Ensemble(_logit(share), ())
    assembled = VectorAssembler(inputCols=list(SHARES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED).fit(assembled)
    rules = sorted({path for tree in forest.trees for path in _paths(tree._call_java("rootNode"))})
    names = {name: F.col(name) for name in SHARES}
    held = F.array(*[conjunction(rule, names).cast("double") for rule in rules])
    matrix = rows.select("label", array_to_vector(held).alias("features"))
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=ROUNDS).fit(matrix)
    weights = [(rule, float(weight)) for rule, weight in zip(rules, lasso.coefficients.toArray(), strict=True) if weight]
    return Ensemble(float(lasso.intercept), tuple(weights))


def _logit(share: float) -> float:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return -log(1 / share - 1)


def known_labels(labels: DataFrame) -> DataFrame:
    """One label per document that may be learned from."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return usable.groupBy("doc_id").agg(F.min("quality").alias("label"))


def scored(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, learned from the same documents.

    The statistics are worked out once and written; learning and scoring read them.
    """
    stats = statistics_of(docs, id_column, text_column)
    ensemble = fit(stats.join(known_labels(labels), "doc_id").select("stats", "label"))
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ensemble.score(F.col("stats")).alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPTED).cast("int")
    )


def keep(docs: DataFrame, ensemble: Ensemble, accepted: float = ACCEPTED, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``accepted``, with their columns. No row is moved."""
    row = packed(docs)
    found = with_statistics(row, row[ROW][text_column], ROW)
    return unpacked(found.where(ensemble.score(F.col("stats")) >= accepted))
