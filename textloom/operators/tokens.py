"""Token rows of a corpus: words, bigrams and stems per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textloom.functions.counting import count_batches
from textloom.functions.stems import LANGUAGES, language_stem
from textloom.functions.text import (
    WORD_GAPS,
    ngrams,
    remove_stopwords,
    split_words,
    tokenize_regex,
)
from textloom.operators.joins import lookup_join
from textloom.session import stored_small as stored

ENGLISH = "english"
LETTERS = r"[\p{L}\p{M}\p{N}_]+"


def explode_words(docs: DataFrame, words: str | Column, id_col: str = "doc_id") -> DataFrame:
    """One ``word, doc_id`` row per element of a word array."""
    words = F.col(words) if isinstance(words, str) else words
    return docs.select(F.explode(words).alias("word"), F.col(id_col).alias("doc_id"))


def word_rows(
    docs: DataFrame, stop_words: Sequence[str] = (), text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Words of all documents without stop words.

    Empty pieces and stop words are dropped after the explode, which keeps the whole step in
    generated code instead of running a lambda per array element.
    """
    rows = explode_words(docs, split_words(F.col(text), WORD_GAPS), id_col).where(F.col("word") != "")
    dropped = sorted({w.lower() for w in stop_words})
    return rows.where(~F.col("word").isin(dropped)) if dropped else rows


def bigram_rows(
    docs: DataFrame, stop_words: Sequence[str] = (), text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """``word, doc_id, stem`` rows of neighbouring words left after the stop list; stem = bigram."""
    words = remove_stopwords(tokenize_regex(F.col(text)), stop_words)
    return explode_words(docs, ngrams(words, 2), id_col).withColumn("stem", F.col("word"))


def unique_ids(docs: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether no id names two rows; reads only the id column."""
    return docs.groupBy(id_col).count().where(F.col("count") > 1).isEmpty()


def _counted(
    docs: DataFrame,
    size: int,
    stop_words: Sequence[str],
    text: str,
    id_col: str,
    ids_unique: bool | None,
    cut: int | None = None,
) -> DataFrame:
    """``doc_id, word, n`` of the runs of ``size`` words left after the stop list.

    Each row is counted in place. Where ids are unique that is the answer and nothing is shuffled;
    otherwise the rows of one id are added up. Uniqueness is checked unless the caller knows it.
    """
    schema = StructType([
        StructField("doc_id", docs.schema[id_col].dataType), StructField("word", StringType()), StructField("n", LongType())
    ])
    dropped = sorted({w.lower() for w in stop_words})
    counts = docs.select(id_col, F.lower(text).alias("text")).mapInArrow(count_batches(size, dropped, cut), schema)
    if ids_unique is None:
        ids_unique = unique_ids(docs, id_col)
    return counts if ids_unique else counts.groupBy("doc_id", "word").agg(F.sum("n").alias("n"))


def word_counts(
    docs: DataFrame,
    stop_words: Sequence[str] = (),
    text: str = "text",
    id_col: str = "doc_id",
    ids_unique: bool | None = None,
    cut: int | None = None,
) -> DataFrame:
    """``doc_id, word, n``: how often each document holds each word that is no stop word.

    With ``cut`` words are counted by their first so many characters, inside the row as well.
    """
    return _counted(docs, 1, stop_words, text, id_col, ids_unique, cut)


def bigram_counts(
    docs: DataFrame,
    stop_words: Sequence[str] = (),
    text: str = "text",
    id_col: str = "doc_id",
    ids_unique: bool | None = None,
) -> DataFrame:
    """``doc_id, word, n``: how often each document holds each bigram left after the stop list."""
    return _counted(docs, 2, stop_words, text, id_col, ids_unique)


def stem_table(words: DataFrame, language: str = ENGLISH, stems: DataFrame | None = None) -> DataFrame:
    """``word, stem, n`` of every distinct word with its number of occurrences, stored.

    ``words`` holds ``word`` and, if already counted, ``n``. English, German, French and Spanish words are
    stemmed by rule, each distinct word once. Other languages need a ``word, stem`` table; a word missing
    from it is its own stem. A stem is one word: tables with blanks in a stem are rejected.
    """
    n = F.sum("n") if "n" in words.columns else F.count(F.lit(1))
    distinct = words.groupBy("word").agg(n.alias("n"))
    if stems is None:
        if language not in LANGUAGES.values():
            raise ValueError(f"stemming {language} needs a table of word, stem")
        stem = language_stem(F.lit(language), F.col("word"))
        return stored(distinct.withColumn("stem", stem).select("word", "stem", "n"), "stems")
    given = stems.groupBy("word").agg(F.min("stem").alias("stem"))
    joined = distinct.join(given, "word", "left")
    table = stored(joined.select("word", F.coalesce("stem", "word").alias("stem"), "n"), "stems")
    if not table.where(F.contains("stem", F.lit(" "))).isEmpty():
        raise ValueError("a stem must not hold a blank")
    return table


def with_stems(rows: DataFrame, table: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Rows with the stem of their word by a stored ``word, stem`` table of all their words.

    Only stems that differ from their word are looked up; ``counts`` holds ``word, _n``, the rows of each word, if known.
    """
    changed = table.where(F.col("stem") != F.col("word")).select("word", "stem")
    found = lookup_join(rows, changed, "word", "left", key_counts=counts)
    return found.withColumn("stem", F.coalesce("stem", "word"))


def stem_words(tokens: DataFrame, language: str = ENGLISH, stems: DataFrame | None = None) -> DataFrame:
    """Token rows with the stem of their word.

    Only the vocabulary passes through the stemmer; the rows get their stem by a lookup. The vocabulary holds the
    number of rows of each word, so the rows are not counted again to find hot words.
    """
    table = stem_table(tokens, language, stems)
    counts = None if "n" in tokens.columns else table.select("word", F.col("n").alias("_n"))
    return with_stems(tokens, table, counts)


def stems_by_language(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, word, stem, n``: every distinct word of each language, its stem and its occurrences.

    Words are runs of letters, marks, digits and ``_`` of any script in lower case. Each is stemmed by the rules
    of its language, given by code (``en, de, fr, es``); in other languages a word is its own stem. Counts are
    combined before the shuffle, so a hot word costs one row for each task.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))
    counts = docs.select(F.col(lang).alias("lang"), F.explode(words).alias("word"))
    counts = counts.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    name = F.element_at(F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair)), F.coalesce("lang", F.lit("")))
    return counts.select("lang", "word", language_stem(name, F.col("word")).alias("stem"), "n")


def union_stems_bigrams(stemmed: DataFrame, bigrams: DataFrame) -> DataFrame:
    """Stems and bigrams in one table, duplicates kept, columns matched by name."""
    return stemmed.unionByName(bigrams)


def doc_stems(
    docs: DataFrame,
    stop_words: Sequence[str],
    language: str = ENGLISH,
    bigrams: bool = False,
    stems: DataFrame | None = None,
) -> DataFrame:
    """``word, doc_id, stem`` rows of a corpus; bigrams are added unstemmed."""
    stemmed = stem_words(word_rows(docs, stop_words), language, stems).select("word", "doc_id", "stem")
    if not bigrams:
        return stemmed
    return union_stems_bigrams(stemmed, bigram_rows(docs, stop_words))
