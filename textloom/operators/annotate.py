"""Annotation columns, and token rows with parts of speech and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.annotations import (
    SENTENCE,
    TOKEN,
    document_annotation,
    sentence_annotations,
    spans,
    token_annotations,
)
from textloom.operators.joins import lookup_join
from textloom.session import stored

# Leading letters of the counted tags and their coarse names; label of no entity.
COARSE_TAGS = {"V": "VERB", "N": "NOUN", "RB": "ADVERB", "J": "ADJECTIVE"}
NO_ENTITY = "O"

# Tags of words missing from the lexicon, by shape; the first pattern found wins.
UNKNOWN_TAGS = (
    (r"^[^\w\s]+$", "SYM"),
    (r"^[0-9]+$", "CD"),
    (r"ing$", "VBG"),
    (r"ed$", "VBD"),
    (r"ly$", "RB"),
    (r"(able|ible|ful|ous|ive|al|ic)$", "JJ"),
    (r"[^s]s$", "NNS"),
)
DEFAULT_TAG = "NN"


def assemble(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the ``document`` annotation column."""
    return docs.withColumn("document", document_annotation(F.col(text)))


def detect_sentences(docs: DataFrame, pattern: str = SENTENCE) -> DataFrame:
    """Add the ``sentence`` annotation column."""
    return docs.withColumn("sentence", sentence_annotations(F.col("document"), pattern))


def tokenize_annotations(docs: DataFrame, pattern: str = TOKEN) -> DataFrame:
    """Add the ``token`` annotation column."""
    return docs.withColumn("token", token_annotations(F.col("sentence"), pattern))


def annotate(docs: DataFrame, text: str = "text") -> DataFrame:
    """Document, sentence and token annotations beside all input columns."""
    return tokenize_annotations(detect_sentences(assemble(docs, text)))


def annotation_rows(docs: DataFrame, column: str, id_col: str = "doc_id") -> DataFrame:
    """One row per annotation of a column, with its sentence number.

    The outer explode keeps Spark from testing the array for emptiness first, which would build all
    annotations twice, the first time before the texts are spread over the cores.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode_outer(column).alias("a"))
    return rows.where(F.col("a").isNotNull()).select(
        "doc_id", "a.annotatorType", "a.begin", "a.end", "a.result",
        F.col("a.metadata")["sentence"].cast("int").alias("sentence"),
    )


def sentence_rows(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, sentence, result`` row per sentence, numbered from 0."""
    found = F.regexp_extract_all(F.col(text), F.lit(SENTENCE), F.lit(0))
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(found).alias("sentence", "result"))


def token_rows(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, sentence, token, word`` row per token, numbered from 0 in its sentence."""
    words = F.regexp_extract_all("result", F.lit(TOKEN), F.lit(0))
    return sentence_rows(docs, text, id_col).select(
        "doc_id", "sentence", F.posexplode(words).alias("token", "word")
    )


def token_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` row per token; the same words as ``token_rows``, as no token holds a blank."""
    return docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0))).alias("word"))


# --- parts of speech ---------------------------------------------------------------------------


def fit_pos_lexicon(tagged: DataFrame) -> DataFrame:
    """``word, pos``: most frequent tag of each lower-cased word of ``word, pos`` rows, ties by tag."""
    counts = tagged.groupBy(F.lower("word").alias("word"), "pos").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("pos").alias("pos")))
    return counts.groupBy("word").agg(best["pos"].alias("pos"))


def unknown_pos(word: Column) -> Column:
    """Tag of a word by its shape."""
    tag = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, name in UNKNOWN_TAGS:
        tag = tag.when(F.rlike(word, F.lit(pattern)), F.lit(name))
    return tag.otherwise(F.lit(DEFAULT_TAG))


def tag_pos(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Add ``pos``: the lexicon's tag of the lower-cased word, else a tag by its shape.

    ``lexicon`` is ``word, pos`` with lower-case, distinct words, cheap to read.
    """
    known = lexicon.select(F.col("word").alias("_key"), F.col("pos").alias("_known"))
    keyed = tokens.withColumn("_key", F.lower("word"))
    tagged = lookup_join(keyed, known, "_key", "left")
    return tagged.withColumn("pos", F.coalesce("_known", unknown_pos(F.col("_key")))).drop("_key", "_known")


def counted_pos(tokens: DataFrame) -> DataFrame:
    """Tokens whose tag starts with one of the counted prefixes."""
    keep = F.lit(False)
    for prefix in COARSE_TAGS:
        keep = keep | F.startswith(F.col("pos"), F.lit(prefix))
    return tokens.where(keep)


def coarse_pos(pos: Column) -> Column:
    """Verb, noun, adverb or adjective by leading letters; any other tag unchanged."""
    name = F.when(F.lit(False), pos)
    for prefix, coarse in COARSE_TAGS.items():
        name = name.when(F.startswith(pos, F.lit(prefix)), F.lit(coarse))
    return name.otherwise(pos)


def pos_word_counts(tokens: DataFrame) -> DataFrame:
    """``word, pos, count`` rows."""
    return tokens.groupBy("word", "pos").agg(F.count(F.lit(1)).alias("count"))


def topk_pos_words(counts: DataFrame, pos: str = "VERB", k: int = 50) -> DataFrame:
    """The ``k`` most frequent words of one tag, ties by word."""
    return counts.where(F.col("pos") == pos).orderBy(F.desc("count"), F.asc("word")).limit(k)


# --- entities ----------------------------------------------------------------------------------


def phrase_lexicon(lexicon: DataFrame) -> DataFrame:
    """``phrase, size, tag`` from ``term, tag`` rows, stored: lower case, tokens joined by a space.

    A phrase listed under several tags keeps the smallest.
    """
    tokens = F.regexp_extract_all(F.lower("term"), F.lit(TOKEN), F.lit(0))
    rows = lexicon.select(
        F.concat_ws(" ", tokens).alias("phrase"), F.size(tokens).alias("size"), "tag"
    ).where(F.col("size") > 0)
    return stored(rows.groupBy("phrase", "size").agg(F.min("tag").alias("tag")), "phrases")


def entity_matches(sentences: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc_id, sentence, token, size, words, tag`` row per place where a phrase starts.

    Each token is laid beside the tokens that follow it, up to the longest phrase. Only phrase
    lengths that occur in the lexicon become candidates, and each candidate meets the lookup in the
    same stage, so those that match nothing go no further.
    """
    # One row per phrase length.
    sizes = [r["size"] for r in phrases.select("size").distinct().orderBy("size").collect()] or [1]
    following = [f"t{k}" for k in range(max(sizes))]
    words = F.regexp_extract_all("result", F.lit(TOKEN), F.lit(0))
    shifted = [F.slice("w", F.lit(k + 1), F.size("w")).alias(name) for k, name in enumerate(following)]
    starts = sentences.select("doc_id", "sentence", words.alias("w")).select(
        "doc_id", "sentence", F.posexplode(F.arrays_zip(*shifted)).alias("token", "t")
    )

    def candidate(size):
        # Null where the sentence ends before the phrase would.
        taken = [part for name in following[:size] for part in (F.lit(" "), F.col(f"t.{name}"))][1:]
        return F.struct(F.lit(size).alias("size"), F.lower(F.concat(*taken)).alias("phrase"))

    candidates = starts.select(
        "doc_id",
        "sentence",
        "token",
        F.array(*[F.col(f"t.{name}") for name in following]).alias("next"),
        F.explode(F.array(*[candidate(size) for size in sizes])).alias("c"),
    ).select("doc_id", "sentence", "token", "next", "c.size", "c.phrase")
    found = lookup_join(candidates, phrases, ["phrase", "size"])
    return found.select(
        "doc_id", "sentence", "token", "size", F.slice("next", F.lit(1), F.col("size")).alias("words"), "tag"
    )


def entity_labels(matches: DataFrame) -> DataFrame:
    """``doc_id, sentence, token, word, ner``: each covered token takes the longest match over it.

    Matches of equal length go to the earlier start, then to the smaller tag. The rows are clustered
    by sentence, which also serves joining neighbours later.
    """
    covered = matches.repartition("doc_id", "sentence").select(
        "doc_id",
        "sentence",
        F.col("token").alias("start"),
        F.struct((-F.col("size")).alias("longest"), F.col("token").alias("start"), "tag").alias("m"),
        F.posexplode("words").alias("offset", "word"),
    )
    return covered.groupBy("doc_id", "sentence", (F.col("start") + F.col("offset")).alias("token"), "word").agg(
        F.min("m")["tag"].alias("ner")
    )


def entity_token_rows(
    docs: DataFrame, lexicon: DataFrame, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Only the tokens inside dictionary entities; other tokens are never shuffled."""
    phrases = phrase_lexicon(lexicon)
    return entity_labels(entity_matches(sentence_rows(docs, text, id_col), phrases))


def tag_entities(docs: DataFrame, lexicon: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All token rows with ``ner``: dictionary tag of the longest phrase over the token, else ``O``.

    Labels of a sentence meet it as one map, so sentences move and not their tokens.
    """
    key = F.struct("token", "word")
    labels = entity_token_rows(docs, lexicon, text, id_col).groupBy("doc_id", "sentence").agg(
        F.map_from_entries(F.collect_list(F.struct(key.alias("key"), F.col("ner").alias("value")))).alias("labels")
    )
    labelled = sentence_rows(docs, text, id_col).join(labels, ["doc_id", "sentence"], "left")
    words = F.posexplode(F.regexp_extract_all("result", F.lit(TOKEN), F.lit(0))).alias("token", "word")
    rows = labelled.select("doc_id", "sentence", "labels", words)
    return rows.select("doc_id", "sentence", "token", "word", F.coalesce(F.col("labels")[key], F.lit(NO_ENTITY)).alias("ner"))


def entity_tokens(tokens: DataFrame) -> DataFrame:
    """Tokens that carry an entity label."""
    return tokens.where(F.col("ner") != NO_ENTITY)


def merge_entity_spans(tokens: DataFrame) -> DataFrame:
    """``doc_id, sentence, first, last, entity, ner``: neighbouring tokens of one label joined.

    Tokens of one label that follow each other keep a constant difference between their position
    and their rank, which marks the run they belong to.
    """
    rank = F.row_number().over(Window.partitionBy("doc_id", "sentence", "ner").orderBy("token"))
    runs = entity_tokens(tokens).withColumn("_run", F.col("token") - rank)
    words = F.sort_array(F.collect_list(F.struct("token", "word")))
    return runs.groupBy("doc_id", "sentence", "ner", "_run").agg(
        F.min("token").alias("first"),
        F.max("token").alias("last"),
        F.array_join(words["word"], " ").alias("entity"),
    ).drop("_run")


def entity_counts(spans_: DataFrame) -> DataFrame:
    """``entity, ner, count``, most frequent first, ties by entity and label."""
    return (
        spans_.groupBy("entity", "ner")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("entity"), F.asc("ner"))
    )
