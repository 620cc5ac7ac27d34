"""Text features; everything stays in Spark's own string functions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.spans import column


def text_length(text) -> Column:
    return F.length(column(text))


def contains_any_of(text, pieces: Sequence[str]) -> Column:
    found = F.lit(False)
    for piece in pieces:
        found = found | column(text).contains(piece)
    return found.cast("int")


def keywords_present(text, keywords: Sequence[str]) -> Column:
    """How many of the listed keywords occur anywhere in the lower-cased text."""
    lowered = F.lower(column(text))
    return sum((lowered.contains(word).cast("int") for word in keywords), F.lit(0))


def _whole_words(words: Sequence[str]) -> str:
    # U: letters of every language count as word characters
    return r"(?iU)\b(" + "|".join(re.escape(word) for word in words) + r")\b"


def mentions(text, words: Sequence[str]) -> Column:
    """Whether any word occurs as a whole word, ignoring case."""
    return column(text).rlike(_whole_words(words)).cast("int")


def count_matches(text, words: Sequence[str]) -> Column:
    return F.regexp_count(column(text), F.lit(_whole_words(words)))


def distinct_items(text, separator: str = ",") -> Column:
    """Number of different items in a separated list."""
    items = F.split(column(text), re.escape(separator))
    return F.size(F.array_distinct(F.filter(items, lambda item: item != "")))
