"""One registered query per operator of this folder; see oracle.py for the SQL of those it can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from textloom.llm import (
    chat,
    decontaminate,
    exact,
    jaccard,
    language,
    line_quality,
    lines,
    negatives,
    packing,
    phrases,
    repeats,
    token_files,
    toxicity,
)
from textloom.llm.common import table
from textloom.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark, sf_dir):
    """Learned from labelled rows outside fold 2 of 4; every text scored."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    fold = language.fold_of(F.col("doc_id"), 4)
    model = toxicity.fit_toxicity(documents, labels.where(~fold.isin(2, -1)))
    scored = toxicity.score_toxicity(documents, model)
    return scored.select(
        "doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged"
    )


@query
def op2_perspective_rotation(spark, sf_dir):
    dialogues = chat.rotated_dialogues(table(spark, sf_dir, "conversations"))
    return dialogues.withColumn("mask", chat.mask_string(F.col("mask")))


@query
def op3_line_dedup(spark, sf_dir):
    """Line counts and digest of the text that is left of every document."""
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", "n_near", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_files.read_token_files(spark, path)


@query
def op5_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_decontaminate(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(documents, benchmark).drop("spans")


@query
def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op8_suffix_array_dedup(spark, sf_dir):
    return repeats.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op9_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


@query
def op10_language_id(spark, sf_dir):
    """Learned from labelled rows outside fold 0 of 5; every text predicted."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = language.fold_of(F.col("doc_id"), 5)
    model = language.fit_languages(documents.where(fold > 0))
    found = language.identify_languages(documents, model)
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op11_hard_negatives(spark, sf_dir):
    """Anchors are the rows whose id is divisible by 50; of ids divisible by 7 the label is moved on by one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query
def op12_line_quality(spark, sf_dir):
    return line_quality.line_quality(table(spark, sf_dir, "documents")).drop("cleaned")


@query
def op13_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))
