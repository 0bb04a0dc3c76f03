"""Words, lines and sizes of texts as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words.
BLANKS = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words of the whole text in order; none for null."""
    return F.array_remove(F.split(whole(text), GAP), "")


def without(text: Column, characters: str) -> Column:
    """The text without the given characters."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def occurrences(text: Column, characters: str) -> Column:
    """How many characters of the text are among the given ones."""
    return (F.length(text) - F.length(without(text, characters))).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
