"""Statistics of whole texts, as built-in Spark expressions.

Every statistic is a count; ``shares`` makes ratios of them. A null or empty text has counts of zero, and a share
of nothing is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcube.llm.text import BLANKS, WORD, let, occurrences, whole, without, words
from tillcube.sources.shared import materialize

# The characters that count as symbols and as marks, and the words of a window.
SYMBOLS = "#*$%&|<>"
MARKS = "!?.,;:"
WINDOW = 8
# Rows with an id and a label that may be sent to every executor: some tens of megabytes.
BROADCAST_ROWS = 1_000_000

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_stutters",
    "n_upper", "n_marks",
)
SHARES = (
    "n_words", "word_length", "symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share",
    "distinct_share", "stutter_share",
)


def _window(items: Column, at: Column) -> list[Column]:
    return [F.get(items, at + step) for step in range(WINDOW)]


def _covered(found: Column) -> Column:
    """Words inside windows that occur twice or more. ``found``: (window, position), sorted."""
    twice = F.filter(
        found,
        lambda x, i: (F.get(found, i - 1)["text"] == x["text"]) | (F.get(found, i + 1)["text"] == x["text"]),
    )
    places = F.array_sort(F.transform(twice, lambda x: x["at"]))
    # Windows are taken from left to right: each adds the words that the one before does not hold.
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum"))
    return F.aggregate(
        places,
        start,
        lambda seen, at: F.struct(at.alias("last"), (seen["sum"] + F.least(at - seen["last"], F.lit(WINDOW))).alias("sum")),
        lambda seen: seen["sum"],
    )


def with_statistics(rows: DataFrame, text: Column, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``rows`` and a struct ``stats`` of the counts of ``text``."""
    base = rows.select(*keep, whole(text).alias("_text"))
    base = base.withColumn("_words", words(F.col("_text")))
    base = base.withColumn("_hashes", F.transform("_words", lambda word: F.xxhash64(word)))
    starts = F.when(F.size("_words") >= WINDOW, F.sequence(F.lit(0), F.size("_words") - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    base = base.withColumn("_starts", starts)
    # Equal windows have equal hashes, so a text without equal hashes has no repeated window; the others compare words.
    base = base.withColumn("_windows", F.transform("_starts", lambda at: F.xxhash64(*_window(F.col("_hashes"), at))))
    exact = F.transform(
        "_starts", lambda at: F.struct(F.concat_ws(" ", *_window(F.col("_words"), at)).alias("text"), at.alias("at"))
    )
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    repeated = F.when(some, let(F.array_sort(exact), _covered)).otherwise(F.lit(0))
    lines = F.split("_text", "\n")
    dup_lines = let(
        F.filter(lines, lambda line: line.rlike(WORD)), lambda kept: F.size(kept) - F.size(F.array_distinct(kept))
    )
    bare = F.length(without(F.col("_text"), BLANKS))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": bare,
        "n_symbols": occurrences(F.col("_text"), SYMBOLS),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeated,
        "n_lines": F.size(lines),
        "n_distinct": F.size(F.array_distinct("_words")),
        # Words equal to the one before.
        "n_stutters": F.size(F.filter("_hashes", lambda word, at: word == F.get("_hashes", at - 1))),
        "n_upper": F.length("_text") - F.length(F.regexp_replace("_text", r"\p{Lu}+", "")),
        "n_marks": occurrences(F.col("_text"), MARKS),
    }
    found = F.struct(*[counts[name].cast("long").alias(name) for name in COUNTS])
    # The condition always holds. Spark takes it for one that may change, and so does not copy the statistics into every
    # expression and filter that uses them, where each copy would be worked out anew.
    return base.select(*keep, F.when(F.spark_partition_id() >= 0, found).alias("stats"))


def statistics_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``stats`` of every row, written once: texts are read where they lie and never moved."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return materialize(with_statistics(rows, F.col("text"), "doc_id"), "statistics")


def statistics_of_some(
    docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``known`` (``doc_id`` and other columns, few bytes each) with the ``stats`` of their documents.

    Up to ``BROADCAST_ROWS`` of them, counted first, go to where the texts lie, so that only their texts are looked at;
    more are joined to the statistics of all documents. Texts are never moved.
    """
    if known.count() > BROADCAST_ROWS:
        return statistics_of(docs, id_column, text_column).join(known, "doc_id")
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return with_statistics(rows.join(F.broadcast(known), "doc_id"), F.col("text"), *known.columns)


def shares(stats: Column) -> dict[str, Column]:
    """Ratios by name, from a struct of counts."""

    def part(of: str, whole_: str) -> Column:
        return F.when(stats[whole_] > 0, stats[of] / stats[whole_]).otherwise(F.lit(0.0))

    ratios = {
        "n_words": stats["n_words"].cast("double"),
        "word_length": part("word_chars", "n_words"),
        "symbol_share": part("n_symbols", "word_chars"),
        "upper_share": part("n_upper", "word_chars"),
        "mark_share": part("n_marks", "word_chars"),
        "dup_line_share": part("n_dup_lines", "n_lines"),
        "repeat_share": part("n_repeat_words", "n_words"),
        "distinct_share": part("n_distinct", "n_words"),
        "stutter_share": part("n_stutters", "n_words"),
    }
    return {name: ratios[name] for name in SHARES}
