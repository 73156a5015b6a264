"""Corpus pipeline: language, exact copies, near copies, benchmark passages, packing.

Every stage takes all rows its predecessor kept. All but the last return the columns of ``documents``; the
last one returns packed pieces. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import decontaminate, exact, jaccard, language, packing
from textloom.llm.common import table
from textloom.llm.queries import TOKENIZER
from textloom.session import scratch_path

# SQL has no form of the language classifier and the tokenizer; tests compare run() with brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told: not null, with letters, one codeword nearest."""
    return language.keep_identified(docs, language.fit_languages(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more."""
    return jaccard.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with at least one word in twenty inside a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("language", identify_language),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
