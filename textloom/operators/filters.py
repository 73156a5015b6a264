"""Row filters and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import HASHTAG_MARK, contains_any, is_stop_word
from textloom.operators.joins import lookup_join

# Language of the scored messages and the sentiment keywords.
MESSAGE_LANGUAGE = "en"
SENTIMENT_KEYWORDS = ("happy", "sad", "love", "hate", "good", "bad")


def with_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text is not null."""
    return docs.where(F.col(text).isNotNull())


def with_hashtag(messages: DataFrame, lang: str = MESSAGE_LANGUAGE, text: str = "text") -> DataFrame:
    """Messages of one language that hold a hashtag mark."""
    return messages.where((F.col("lang") == lang) & F.contains(F.col(text), F.lit(HASHTAG_MARK)))


def with_any_keyword(
    messages: DataFrame,
    keywords: Sequence[str] = SENTIMENT_KEYWORDS,
    lang: str = MESSAGE_LANGUAGE,
    text: str = "text",
    whole_words: bool = False,
) -> DataFrame:
    """Messages of one language that hold any keyword, also inside a longer word."""
    return messages.where((F.col("lang") == lang) & contains_any(F.col(text), keywords, whole_words))


def status_like(records: DataFrame, pattern: str, status: str = "status") -> DataFrame:
    return records.where(F.col(status).like(pattern))


def query_view(df: DataFrame, view: str, query: str, **args: object) -> DataFrame:
    """Register ``df``, batch or stream, under a name and query it with SQL text.

    Values are bound as named parameters, never pasted into the text.
    """
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(query, args=args or None)


def in_set(docs: DataFrame, oid: str, field: str = "mongoSetId") -> DataFrame:
    """Documents whose nested set id equals ``oid``."""
    return docs.where(F.col(field)["oid"] == oid)


def key_not_null(df: DataFrame, key: str) -> DataFrame:
    """Rows safe to hand to a sink that rejects null keys."""
    return df.where(F.col(key).isNotNull())


def having_min_count(trend: DataFrame, more_than: int = 3, count: str = "count") -> DataFrame:
    """Groups counted strictly more often than the threshold."""
    return trend.where(F.col(count) > more_than)


def without_stopword_rows(
    tokens: DataFrame, stop_words: Sequence[str], word: str = "word", case_sensitive: bool = True
) -> DataFrame:
    """Token rows that are not stop words, tested row by row."""
    return tokens.where(~is_stop_word(F.col(word), stop_words, case_sensitive))


def stopword_anti_join(tokens: DataFrame, stop_table: DataFrame, word: str = "word") -> DataFrame:
    """Same result from a stop list held as a table of one ``word`` column."""
    return lookup_join(tokens, stop_table.select(F.col("word").alias(word)).distinct(), word, "left_anti")


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Only the given columns, under new names."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def with_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def object_id(value: object) -> Column:
    """A document-store id: struct with one ``oid`` field."""
    return F.struct(F.lit(value).cast("string").alias("oid"))
