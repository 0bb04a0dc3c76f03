"""From raw documents to packed sequences.

Each stage takes the documents that the one before kept and applies one operator. All but the last return whole
rows of the documents. What the classifier and the rules know they learn from the labelled ones among all documents.

Defined cases: a null text counts as the empty one, which the base rules reject; rows without an id go through like any
other and are kept once per group of equal texts; repeated rows are copies; extra columns stay until packing, which
returns its own; without documents there are no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillcube.llm import exact_dedup, packing, quality_classifier, quality_rules, simhash_dedup
from tillcube.llm.statistics import statistics_of_some
from tillcube.llm.tables import documents, labels
from tillcube.sources.shared import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    known = quality_classifier.known_labels(labels(spark, sf_dir))
    return quality_classifier.keep(docs, quality_classifier.fit(statistics_of_some(documents(spark, sf_dir), known)))


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no learned rule and no base rule rejects."""
    known = quality_rules.known_labels(labels(spark, sf_dir))
    return quality_rules.keep(docs, quality_rules.learn(statistics_of_some(documents(spark, sf_dir), known)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints over three-word shingles that differ in two bits or fewer."""
    return simhash_dedup.deduplicate(docs, simhash_dedup.SHINGLE, simhash_dedup.RADIUS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    return packing.pack(packing.pieces(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classified),
    ("quality_rules", ruled),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("best_fit_packing", packed),
]

# The classifier and the rules are learned when the stages run, and SQL has no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
