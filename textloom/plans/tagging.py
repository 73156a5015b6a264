"""Part-of-speech and entity reports of a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import default_stop_words
from textloom.operators.annotate import (
    coarse_pos,
    counted_pos,
    entity_counts,
    entity_token_rows,
    merge_entity_spans,
    tag_pos,
    token_words,
    topk_pos_words,
)
from textloom.operators.filters import without_stopword_rows


def count_pos_words(docs: DataFrame, lexicon: DataFrame, language: str = "english") -> DataFrame:
    """``word, pos, count`` of verbs, nouns, adverbs and adjectives that are no stop words.

    The tag depends on the word alone, so tokens are counted by word first and only distinct words
    are tagged.
    """
    kept = without_stopword_rows(token_words(docs), default_stop_words(language))
    counted = kept.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    tagged = counted_pos(tag_pos(counted, lexicon))
    return tagged.select("word", coarse_pos(F.col("pos")).alias("pos"), "count")


def top_words(docs: DataFrame, lexicon: DataFrame, pos: str = "VERB", k: int = 50) -> DataFrame:
    """The ``k`` most frequent words of one part of speech."""
    return topk_pos_words(count_pos_words(docs, lexicon), pos, k)


def count_entities(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Entities of a corpus, most frequent first."""
    return entity_counts(merge_entity_spans(entity_token_rows(docs, lexicon)))
