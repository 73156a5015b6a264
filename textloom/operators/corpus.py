"""Vocabulary, sparse document vectors and the n-gram dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.joins import lookup_join
from textloom.session import stored_small as stored

def with_rank(df: DataFrame, *order: Column, name: str = "index", label: str = "ranked") -> DataFrame:
    """Add the 0-based position of each row in a total order, without sorting in one task.

    Rows are range-partitioned by the order and stored together with their partition number. The
    position is the number of rows in earlier partitions plus the place inside the own one. Ties
    of the leading keys are split between partitions as long as the whole order is unique.
    """
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)
    # One row per range partition.
    sizes = parts.groupBy("_part").count()
    before = F.sum("count").over(Window.orderBy("_part")) - F.col("count")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parts.withColumn("_place", place)
        .join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
        .withColumn(name, (F.col("_before") + F.col("_place") - 1).cast("int"))
        .drop("_part", "_place", "_before")
    )


def doc_term_counts(tokens: DataFrame, term: str = "stem") -> DataFrame:
    """``doc_id, term, n``: how often each document holds each term of a token table.

    For documents with their text at hand, ``word_counts`` gives the same without a shuffle.
    """
    return tokens.groupBy("doc_id", F.col(term).alias("term")).agg(F.count(F.lit(1)).alias("n"))


def term_stats(counts: DataFrame) -> DataFrame:
    """``term, cf, df``: occurrences and documents per term.

    Each document and term is one row already, so document frequency needs no distinct count.
    """
    return counts.groupBy("term").agg(F.sum("n").alias("cf"), F.count(F.lit(1)).alias("df"))


def vocabulary_fit(counts: DataFrame, min_df: int = 1, max_size: int | None = None) -> DataFrame:
    """``index, term, cf, df`` of the terms found in at least ``min_df`` documents.

    Index 0 is the most frequent term; ties are ordered by term. ``max_size`` keeps only the most
    frequent terms; without it the vocabulary is whole.
    """
    return ranked_terms(term_stats(counts), min_df, max_size)


def ranked_terms(stats: DataFrame, min_df: int = 1, max_size: int | None = None) -> DataFrame:
    """``vocabulary_fit`` of terms whose ``term, cf, df`` are known."""
    kept = stats.where(F.col("df") >= min_df)
    ranked = with_rank(kept, F.desc("cf"), F.asc("term"), label="vocabulary")
    if max_size is not None:
        ranked = ranked.where(F.col("index") < max_size)
    return ranked.select("index", "term", "cf", "df")


def doc_features(
    counts: DataFrame, vocabulary: DataFrame, classifier_id: str, stats: DataFrame | None = None
) -> DataFrame:
    """``d, indexes, counts, cId``: sparse term vector per document, indexes ascending.

    A document without any vocabulary term keeps a row with empty arrays. ``counts`` and ``vocabulary`` have to be
    cheap to read; ``stats`` (``term, df``), if known, spares counting the rows of each term. Only index and count
    pairs of one document meet in a group, at most one pair per vocabulary term, and only pairs in the vocabulary move.
    """
    rows_of = None if stats is None else stats.select("term", F.col("df").alias("_n"))
    known = lookup_join(counts, vocabulary.select("term", "index"), "term", key_counts=rows_of)
    # Index and count in one number, which orders by index and takes half the room of a struct in the shuffle.
    pair = F.shiftleft(F.col("index").cast("long"), 32).bitwiseOR(F.col("n").cast("int").cast("long"))
    pairs = known.select("doc_id", pair.alias("pair"))
    # One row without a pair keeps documents that hold no vocabulary term.
    every = counts.select("doc_id").distinct().withColumn("pair", F.lit(None).cast("long"))
    # Pairs are brought together before they are collected: a task of the join holds a few of every document.
    together = pairs.union(every).repartition("doc_id")
    vectors = together.groupBy("doc_id").agg(F.sort_array(F.collect_list("pair")).alias("pairs"))
    return vectors.select(
        F.col("doc_id").alias("d"),
        F.transform("pairs", lambda p: F.shiftright(p, 32).cast("int")).alias("indexes"),
        F.transform("pairs", lambda p: p.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).alias("counts"),
        F.lit(classifier_id).alias("cId"),
    )


def word_totals(tokens: DataFrame) -> DataFrame:
    """``stem, word, n``: occurrences of each surface form of a stem.

    ``tokens`` holds one row per token, or counted rows with ``n``.
    """
    n = F.sum("n") if "n" in tokens.columns else F.count(F.lit(1))
    return tokens.groupBy("stem", "word").agg(n.alias("n"))


def stem_forms(totals: DataFrame) -> DataFrame:
    """``stem, unstemmed, count``: sorted distinct surface forms and occurrences per stem.

    ``totals`` holds one row per stem and word, so a hot stem brings only its distinct words.
    """
    return totals.groupBy("stem").agg(
        F.sort_array(F.collect_list("word")).alias("unstemmed"), F.sum("n").alias("count")
    )


def ngram_index(forms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add the vocabulary index to each stem; stems outside the vocabulary are dropped."""
    index = vocabulary.select(F.col("term").alias("stem"), F.col("index").cast("long").alias("index"))
    return lookup_join(forms, index, "stem", keys_distinct=True)


def ngram_dictionary(totals: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``stem, unstemmed, count, index, word``; the smallest surface form stands for the stem."""
    indexed = ngram_index(stem_forms(totals), vocabulary)
    return indexed.select(
        "stem", "unstemmed", "count", "index", F.get("unstemmed", F.lit(0)).alias("word")
    )
