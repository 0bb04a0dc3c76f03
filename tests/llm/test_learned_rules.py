"""What is learned, read in plain Python; and very long texts."""

import math
import zlib
from collections import defaultdict

import odd
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_queries_brute_force import best_fit, fingerprint, pieces_of
from tokenizers import Tokenizer

from tillcube.llm import quality_classifier, quality_rules
from tillcube.llm.queries import QUERIES
from tillcube.llm.statistics import statistics_of
from tillcube.llm.tables import documents, labels
from tillcube.llm.tokens import tokenizer_path

FOLDER = "/root/testdata/sf0.01"


def shares(text):
    """Statistics of a text by name, from its characters."""
    text = text or ""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = odd.statistics(text)
    found = odd.words(text)
    upper = sum(letter.isupper() for letter in text)
    marks = sum(letter in "!?.,;:" for letter in text)
    stutters = sum(a == b for a, b in zip(found, found[1:], strict=False))

    def part(of, whole):
        return of / whole if whole else 0.0

    return {
        "n_words": float(n_words), "word_length": part(word_chars, n_words), "symbol_share": part(n_symbols, word_chars),
        "upper_share": part(upper, word_chars), "mark_share": part(marks, word_chars),
        "dup_line_share": part(n_dup_lines, len(text.split("\n"))), "repeat_share": part(n_repeat_words, n_words),
        "distinct_share": part(len(set(found)), n_words), "stutter_share": part(stutters, n_words),
    }


def holds(rule, values):
    return all((values[c.statistic] >= c.threshold) == c.at_least for c in rule)


def fails_base(text):
    counts = odd.statistics(text)
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


@pytest.fixture(scope="module", params=["odd", FOLDER])
def folder(request, odd_folder):
    return odd_folder if request.param == "odd" else request.param


@pytest.fixture(scope="module")
def rows(spark, folder):
    found = documents(spark, folder).select("doc_id", "text").collect()
    return [(row.doc_id, row.text, shares(row.text)) for row in found]


@pytest.fixture(scope="module")
def stats(spark, folder):
    return statistics_of(documents(spark, folder))


def test_the_list_is_read_rule_by_rule(spark, folder, rows, stats):
    rules = quality_rules.learn(stats.join(quality_rules.known_labels(labels(spark, folder)), "doc_id"))
    if folder == FOLDER:
        assert rules
    hand_made = [
        (quality_rules.Condition("distinct_share", False, 0.4),),
        (quality_rules.Condition("n_words", True, 30.0), quality_rules.Condition("mark_share", False, 0.02)),
    ]
    for chosen in (rules, hand_made):
        expected = odd.many(
            (doc_id, fails_base(text), not fails_base(text) and not any(holds(rule, values) for rule in chosen))
            for doc_id, text, values in rows
        )
        found = quality_rules.judged(stats, chosen).collect()
        assert odd.many((row.doc_id, row.base_failed, row.kept) for row in found) == expected


def test_the_first_condition_gains_most(spark, stats, folder, rows):
    if folder != FOLDER:
        return
    known = stats.join(quality_rules.known_labels(labels(spark, folder)), "doc_id")
    pruning = F.pmod(F.xxhash64("doc_id"), F.lit(quality_rules.PRUNING_SHARE)) == 0
    labelled = known.select("doc_id", "low", pruning.alias("pruning")).collect()
    values = {doc_id: found for doc_id, _, found in rows}
    growing = [(values[row.doc_id], row.low) for row in labelled if not row.pruning]
    all_low = sum(low for _, low in growing)

    def gain(statistic, at_least, threshold):
        inside = [low for found, low in growing if (found[statistic] >= threshold) == at_least]
        if not sum(inside):
            return 0.0
        return sum(inside) * (math.log2(sum(inside) / len(inside)) - math.log2(all_low / len(growing)))

    first = quality_rules.learn(known)[0][0]
    reached = gain(*first)
    # Every value of every statistic, not only the quantiles that are candidates.
    best = max(
        gain(statistic, at_least, threshold)
        for statistic in first_names(growing)
        for threshold in {found[statistic] for found, _ in growing}
        for at_least in (True, False)
    )
    assert reached > 0 and reached >= 0.9 * best


def first_names(growing):
    return list(growing[0][0])


def test_scores_are_the_weights_of_the_rules_that_hold(spark, folder, rows, stats):
    known = stats.join(quality_classifier.known_labels(labels(spark, folder)), "doc_id")
    ensemble = quality_classifier.fit(known.select("stats", "label"))
    assert folder != FOLDER or ensemble.weights
    expected = defaultdict(list)
    for doc_id, _, values in rows:
        total = ensemble.intercept + sum(weight for rule, weight in ensemble.weights if holds(rule, values))
        expected[doc_id].append(1 / (1 + math.exp(-total)))
    found = defaultdict(list)
    for row in QUERIES["op5_quality_classifier"](spark, folder).collect():
        found[row.doc_id].append(row.score)
    assert {x: sorted(y) for x, y in found.items()} == {
        x: [pytest.approx(score, abs=1e-6) for score in sorted(y)] for x, y in expected.items()
    }


LONG = [
    odd.prose(1, 40_000, "abcdeé"),
    "\n".join(odd.prose(seed % 60, 30) for seed in range(1500)),
    "x" * 20_000 + " " + odd.prose(3, 50),
    "word " * 30_000,
]


@pytest.fixture(scope="module")
def long_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("long"))
    table = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_very_long_texts(spark, long_folder):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    counted = {row.doc_id: tuple(row[name] for name in names) for row in QUERIES["op1_quality_rules"](spark, long_folder).collect()}
    assert counted == {at: odd.statistics(text) for at, text in enumerate(LONG)}
    prints = {row.doc_id: row.fingerprint for row in QUERIES["op6_simhash_near_dedup"](spark, long_folder).collect()}
    assert prints == {at: f"{fingerprint(text):016x}" for at, text in enumerate(LONG)}
    bytes_, words = (Tokenizer.from_file(tokenizer_path(x)) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    packed = QUERIES["op4_best_fit_packing"](spark, long_folder).collect()
    expected = []
    for at, text in enumerate(LONG):
        ids = [*bytes_.encode(text, add_special_tokens=False).ids, 2]
        expected += [(at, piece, start, len(part), odd.checksum(part)) for piece, start, part in pieces_of(ids)]
    assert odd.many((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == odd.many(expected)
    assert len({row.sequence_id for row in packed}) == best_fit([row.length for row in packed], 1024)
    files = {row.doc_id: (row.n_tokens, row.ids_crc32) for row in QUERIES["op8_token_files"](spark, long_folder).collect()}
    for at, text in enumerate(LONG):
        ids = [*words.encode(text, add_special_tokens=False).ids, 1]
        assert files[at] == (len(ids), odd.checksum(ids))
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for row in QUERIES["op10_sentencepiece"](spark, long_folder).collect():
        assert row.ids == model.encode(LONG[row.doc_id]) and row.decoded_equal


def test_held_out_rows_are_those_of_the_remainder(spark, odd_folder):
    found = QUERIES["op5_quality_classifier"](spark, odd_folder).collect()
    for row in found:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
