"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcube.llm import (
    bpe_codec,
    exact_dedup,
    hard_negatives,
    line_dedup,
    manifest,
    packing,
    piece_viterbi,
    quality_classifier,
    quality_rules,
    sharding,
    simhash_dedup,
    token_counts,
    token_files,
)
from tillcube.llm.statistics import statistics_of
from tillcube.llm.tables import documents, embeddings, labels
from tillcube.sources.shared import new_path

TOKEN_LIMIT = 1024


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    stats = statistics_of(documents(spark, folder))
    rules = quality_rules.learn(stats.join(quality_rules.known_labels(labels(spark, folder)), "doc_id"))
    return quality_rules.judged(stats, rules)


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.assignments(documents(spark, folder))
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = line_dedup.deduplicate(documents(spark, folder))
    return cut.select("doc_id", "text", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.pieces(documents(spark, folder)))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.scored(documents(spark, folder), labels(spark, folder))


def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.groups(documents(spark, folder))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.marks(documents(spark, folder))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token_files")
    token_files.write(documents(spark, folder), path)
    return token_files.read_checksums(spark, path)


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.counts(documents(spark, folder))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return piece_viterbi.encode_and_check(documents(spark, folder))


def op11_bpe_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.round_trip(documents(spark, folder))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    altered = manifest.leaf(*[lowered if name == "text" else F.col(name) for name in manifest.FIELDS])
    built = manifest.build(docs, carried={"altered": F.when(tampered, altered)})
    found = manifest.proofs(built).withColumn("folded_root", manifest.folded(F.coalesce("altered", "leaf"), F.col("siblings")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("siblings")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = embeddings(spark, folder)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_sharding": op2_sharding,
    "op3_line_dedup": op3_line_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_files": op8_token_files,
    "op9_token_counts": op9_token_counts,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_bpe_automaton": op11_bpe_automaton,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}
