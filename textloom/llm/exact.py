"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fold
from textloom.session import stored

# A chunk ends at the first blank after a vowel or a sentence end past the least length, at the latest
# at the greatest length.
MIN_CHUNK, MAX_CHUNK = 1024, 8192


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    return rf"(?s).{{{least},{most - 2}}}?[aeo.!?]\s|.{{1,{most}}}"


def chunk_texts(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """``doc_id, text_sha256, pos, chunk_sha256, chunk``; an empty text has one row without chunk."""
    folded = docs.select("doc_id", fold(F.col("text")).alias("folded"))
    chunks = F.regexp_extract_all("folded", F.lit(chunk_pattern(least, most)), F.lit(0))
    rows = folded.select(
        "doc_id", F.sha2("folded", 256).alias("text_sha256"), F.posexplode_outer(chunks).alias("pos", "chunk")
    )
    return rows.withColumn("chunk_sha256", F.unhex(F.sha2("chunk", 256)))


def verified_chunks(chunks: DataFrame) -> DataFrame:
    """``chunk_sha256, first_doc, first_pos``: each distinct chunk named by the place it is first seen.

    Chunks are grouped by their whole text, so a text crosses the network once per task that holds it
    and equal digests are checked against equal texts. Two texts of one digest end the job.
    """
    whole = chunks.where(F.col("chunk").isNotNull())
    place = F.struct(F.col("doc_id").alias("first_doc"), F.col("pos").alias("first_pos"))
    texts = whole.groupBy("chunk_sha256", "chunk").agg(F.min(place).alias("place"))
    known = texts.groupBy("chunk_sha256").agg(F.count(F.lit(1)).alias("texts"), F.min("place").alias("place"))
    checked = F.when(F.col("texts") == 1, F.col("place")).otherwise(
        F.raise_error(F.lit("two chunk texts share a digest"))
    )
    return known.select("chunk_sha256", checked.alias("place"))


def recipes(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """``doc_id, text_sha256, recipe, copies``: the ordered chunk names of each document, and the rows that hold it."""
    chunks = chunk_texts(docs, least, most)
    named = chunks.drop("chunk").join(verified_chunks(chunks), "chunk_sha256", "left")
    step = F.when(F.col("place").isNotNull(), F.struct("pos", "place"))
    return named.groupBy("doc_id", "text_sha256").agg(
        F.transform(F.sort_array(F.collect_set(step)), lambda x: x["place"]).alias("recipe"),
        F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).alias("copies"),
    )


def exact_duplicates(docs: DataFrame, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every document.

    Texts are equal if they are identical after lower-casing A-Z; null counts as empty. The largest
    ``doc_id`` of equal texts stays. Documents are compared by recipe: the ordered names of their
    chunks. A chunk's text is moved once to give it a name; after that only names move, so a long
    document costs a few bytes per chunk.

    Edge cases: rows that agree in ``doc_id`` and text are counted and returned one by one; rows of one ``doc_id``
    with different texts are several documents. A null ``doc_id`` stays only if its group has no other. All empty
    texts are one group. An empty table gives no rows; other columns are ignored.
    """
    own = recipes(docs, least, most).withColumn("recipe_hash", F.xxhash64("recipe"))
    groups = own.groupBy("recipe_hash", "recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    rows = own.join(groups, ["recipe_hash", "recipe"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one for each document kept.

    Rows that agree in ``doc_id`` and text but not in other columns are one document; any one of them stays. Whole rows
    are shuffled once, by the join; only documents that several rows hold are shuffled again.
    """
    kept = exact_duplicates(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("_copies"))
    kept = stored(kept.toDF("_kept_id", "_kept_text", "_copies"), "kept")
    digest = F.sha2(fold(docs["text"]), 256)
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (digest == kept["_kept_text"])
    single = docs.join(kept.where(kept["_copies"] == 1), same, "left_semi")
    several = kept.where(kept["_copies"] > 1)
    if several.isEmpty():
        return single
    row = F.struct(*(docs[c] for c in docs.columns)).alias("_row")
    held = docs.join(several, same).select(kept["_kept_id"].alias("_id"), kept["_kept_text"].alias("_text"), row).dropDuplicates(["_id", "_text"])
    return single.union(held.select("_row.*"))
