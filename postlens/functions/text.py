"""Text expressions.  All of them are native Spark functions, no Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning and tokenizing patterns (Java regex, ASCII classes).
URL = r"http\S+"
NOT_LETTER_OR_SPACE = r"[^a-z\s]"  # for lowercase text; a class with A-Z too runs 8 times slower
NON_WORD = r"\W+"

# Unicode alternative for text that is not English.
UNICODE_NON_WORD = r"[^\p{L}\p{N}_]+"


def normalized(text: Column) -> Column:
    """Trimmed (spaces only) and lowercased text, as the models and word counts use it."""
    return F.lower(F.trim(text))


def clean(text: Column) -> Column:
    """Lowercase, drop URLs, then delete everything that is neither a letter nor white space.

    Characters are deleted, not replaced by a space: ``ok-ok`` becomes ``okok``.
    """
    without_urls = F.regexp_replace(F.lower(text), URL, "")
    return F.regexp_replace(without_urls, NOT_LETTER_OR_SPACE, "")


def word_count(text: Column) -> Column:
    """Number of pieces between single spaces; empty pieces count, NULL stays NULL.

    Equal to ``size(split(text, ' '))`` without building the array.
    """
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def pieces(text: Column, pattern: str = NON_WORD) -> Column:
    """Text split on ``pattern``.  May hold empty strings; callers that explode filter them after."""
    return F.split(text, pattern)


def tokens(text: Column, pattern: str = NON_WORD, stop_words: Sequence[str] = ()) -> Column:
    """Lowercase tokens in text order, without empty ones and without ``stop_words``.

    NULL text gives an empty array.
    """
    stops = [w for w in dict.fromkeys(s.lower() for s in stop_words) if w]
    if stops:
        keep = lambda w: (w != "") & ~w.isin(stops)
    else:
        keep = lambda w: w != ""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), pattern), keep)


def english_stop_words() -> list[str]:
    """Spark's default English list (needs a running session)."""
    return StopWordsRemover.loadDefaultStopWords("english")
