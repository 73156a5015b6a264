"""Tokens, stop words, n-grams and hashtags as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Gaps between words, gaps between plain tokens, hashtag mark.
# Runs of gaps are taken as one because empty words are dropped anyway.
WORD_GAPS = r"\W+"
TOKEN_GAP = r"\s"
BLANKS = " \t\n\x0b\f\r"
HASHTAG_MARK = "#"


def default_stop_words(language: str = "english") -> list[str]:
    """Spark's stop list of a language; an unknown language raises ``IllegalArgumentException``."""
    return list(StopWordsRemover.loadDefaultStopWords(language))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column, gaps: str = WORD_GAPS) -> Column:
    """Lower-cased pieces between gaps; may hold empty strings at both ends."""
    return F.split(F.lower(text), gaps)


def tokenize_regex(text: Column, gaps: str = WORD_GAPS, min_length: int = 1) -> Column:
    """Lower-cased words between gaps, words shorter than ``min_length`` dropped."""
    if min_length == 1:
        return F.array_remove(split_words(text, gaps), "")
    return F.filter(split_words(text, gaps), lambda w: F.length(w) >= min_length)


def tokenize_whitespace(text: Column) -> Column:
    """Lower-cased tokens between single whitespace characters; empty tokens stay.

    Trailing empty tokens are dropped, as in a Java string split, unless the text is empty.
    """
    body = F.rtrim(F.lower(text), F.lit(BLANKS))
    return F.when((body == "") & (text != ""), F.array().cast("array<string>")).otherwise(
        F.split(body, TOKEN_GAP)
    )


def is_stop_word(word: Column, stop_words: Sequence[str], case_sensitive: bool = False) -> Column:
    if case_sensitive:
        return word.isin(list(stop_words))
    return F.lower(word).isin([w.lower() for w in stop_words])


def remove_stopwords(words: Column, stop_words: Sequence[str], case_sensitive: bool = False) -> Column:
    """Array without stop words."""
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~is_stop_word(w, stop_words, case_sensitive))


def ngrams(words: Column, n: int = 2) -> Column:
    """Runs of ``n`` words joined with one space; an array shorter than ``n`` gives none."""

    def runs(w: Column) -> Column:
        count = F.greatest(F.size(w) - (n - 1), F.lit(0))
        joined = F.slice(w, F.lit(1), count)
        for k in range(1, n):
            joined = F.zip_with(joined, F.slice(w, F.lit(k + 1), count), lambda run, word: F.concat(run, F.lit(" "), word))
        return joined

    return bind(words, runs)


def runs_of_equal(words: Column) -> Column:
    """Equal elements of an array brought together: one string per distinct element.

    Each string repeats its element, every time followed by a line break; ``run_word`` and
    ``run_length`` read it back. Sorting and matching both run in native code, so counting the words
    of a text needs neither a lambda nor a shuffle. Elements must not hold line breaks or be empty,
    which holds for words and n-grams between ``WORD_GAPS``.
    """
    lines = F.concat(F.array_join(F.sort_array(words), "\n"), F.lit("\n"))
    return F.regexp_extract_all(lines, F.lit(r"([^\n]+\n)\1*"), F.lit(0))


def run_word(run: Column) -> Column:
    return F.substring_index(run, "\n", 1)


def run_length(run: Column) -> Column:
    return (F.length(run) / (F.length(run_word(run)) + 1)).cast("long")


def extract_hashtags(status: Column) -> Column:
    """Words of a status, split on one space, that start with the hashtag mark."""
    return F.filter(F.split(status, " "), lambda w: F.startswith(w, F.lit(HASHTAG_MARK)))


def contains_any(text: Column, keywords: Sequence[str], whole_words: bool = False) -> Column:
    """True where any keyword occurs, case-sensitive, inside words too unless ``whole_words``."""
    if not keywords:
        return F.lit(False)
    if whole_words:
        tests = [F.array_contains(F.split(text, WORD_GAPS), k) for k in keywords]
    else:
        tests = [F.contains(text, F.lit(k)) for k in keywords]
    hit = tests[0]
    for test in tests[1:]:
        hit = hit | test
    return hit
