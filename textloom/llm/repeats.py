"""Repeated passages by sparse suffixes at minimiser positions and the word runs they hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import (
    BLANK_WORDS,
    RunHasher,
    arrow_text,
    gram_hashes,
    hash_words,
    in_filter,
    slabs,
)
from textloom.session import stored

MIN_WORDS = 50
# Words whose hash picks the positions and heads a suffix, and windows of them that share one position.
# HEAD + SPREAD - 1 <= MIN_WORDS, so every run of MIN_WORDS words keeps a position with its whole head.
HEAD, SPREAD = 26, 25
# Bits of each filter over heads that stand in several documents.
FILTER_BITS = 26

RUNS = "run long, doc_id long, pos int, end int, first_char int, last_char int"


def minimisers(heads: np.ndarray, spread: int = SPREAD) -> np.ndarray:
    """Per window of ``spread`` consecutive heads, the position of the first smallest."""
    windows = np.lib.stride_tricks.sliding_window_view(heads, spread)
    return windows.argmin(axis=1) + np.arange(len(windows))


def run_hashes(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the words from ``first`` to before ``last``."""
    return RunHasher(words.view(np.uint8))(8 * first, 8 * last)


def cells(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``head, first, last``: neighbouring runs of ``min_words`` words with the same suffix, and the words they hold."""
    heads = gram_hashes(words, HEAD)
    at = minimisers(heads)[: len(words) - min_words + 1]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return heads[at[first]], first, np.append(first[1:], len(at)) + min_words - 1


def _with_id(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")


def sparse_suffixes(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``head, cell, doc_id``: the suffixes kept of every text, named by the hash of their first words, and their cells."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = arrow_text(batch.column(1))
            for a, b in slabs(offsets):
                hashes, _, _, before = hash_words(data, offsets[a : b + 1], BLANK_WORDS)
                found: list[list[np.ndarray]] = [[], [], []]
                for i in range(b - a):
                    words = hashes[before[i] : before[i + 1]]
                    if len(words) < min_words:
                        continue
                    head, first, last = cells(words, min_words)
                    owner = np.full(len(head), ids[a + i], np.int64)
                    for column, values in zip(found, (head, run_hashes(words, first, last), owner)):
                        column.append(values)
                if found[0]:
                    columns = [pa.array(np.concatenate(c).view(np.int64)) for c in found]
                    yield pa.RecordBatch.from_arrays(columns, names=["head", "cell", "doc_id"])

    return _with_id(docs).mapInArrow(suffixes, "head long, cell long, doc_id long")


def head_filters(suffixes: DataFrame) -> np.ndarray:
    """Two bit sets: heads that stand in several documents, and those of them with several cells.

    Their size is fixed (8 MB each) however many heads there are. A bit too many only makes rows that meet nothing,
    or runs one by one instead of a cell.
    """
    ends = [f(c).alias(f"{n}_{c}") for c in ("doc_id", "cell") for n, f in (("low", F.min), ("high", F.max))]
    shared = suffixes.groupBy("head").agg(*ends).where("low_doc_id <> high_doc_id")
    slot = F.col("head").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("shiftleft(1L, bit)")
    words = shared.select(
        F.shiftrightunsigned(slot, 5).alias("word"),
        slot.bitwiseAND(F.lit(31)).cast("int").alias("bit"),
        (F.col("low_cell") != F.col("high_cell")).alias("mixed"),
    )
    several = F.when(F.col("mixed"), bit).otherwise(F.lit(0).cast("long"))
    found = words.groupBy("word").agg(F.bit_or(bit).alias("any"), F.bit_or(several).alias("mixed")).toArrow()
    out = np.zeros((2, 1 << (FILTER_BITS - 5)), np.uint32)
    for bits, column in zip(out, ("any", "mixed")):
        bits[found["word"].to_numpy()] = found[column].to_numpy().astype(np.uint32)
    return out


def shared_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``run, doc_id, pos, end, first_char, last_char``: the runs of words that may stand in two documents.

    Two equal runs of ``min_words`` words have the same suffix at the same place, so only those whose head
    stands in several documents are kept. A cell is one run where its head has no other cell in any document;
    all other cells give each of their runs of ``min_words`` words.
    """
    live = docs.sparkSession.sparkContext.broadcast(head_filters(sparse_suffixes(docs, min_words)))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (several, mixed), names = live.value, [f.split()[0] for f in RUNS.split(", ")]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = arrow_text(batch.column(1))
            for a, b in slabs(offsets):
                hashes, begin, end, before = hash_words(data, offsets[a : b + 1], BLANK_WORDS)
                raw = data[offsets[a] : offsets[b]]
                # Characters before each byte.
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                found: list[list[np.ndarray]] = [[] for _ in names]
                for i in range(b - a):
                    words = hashes[before[i] : before[i + 1]]
                    if len(words) < min_words:
                        continue
                    head, first, last = cells(words, min_words)
                    slots = (head & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                    kept, single = in_filter(several, slots), in_filter(mixed, slots)
                    whole, apart = kept & ~single, kept & single
                    count = last[apart] - first[apart] - min_words + 1
                    inner = np.repeat(first[apart] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                    x = np.concatenate([first[whole], inner])
                    y = np.concatenate([last[whole], inner + min_words])
                    if not len(x):
                        continue
                    start = chars[offsets[a + i] - offsets[a]]
                    values = (
                        run_hashes(words, x, y).view(np.int64),
                        np.full(len(x), ids[a + i], np.int64),
                        x.astype(np.int32),
                        y.astype(np.int32),
                        (chars[begin[before[i] + x]] - start).astype(np.int32),
                        (chars[end[before[i] + y - 1]] - start).astype(np.int32),
                    )
                    for column, part in zip(found, values):
                        column.append(part)
                if found[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], names=names)

    return stored(_with_id(docs).mapInArrow(runs, RUNS), "runs")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, pos, end, first_char, last_char, other``: every run that stands in another document, and the smallest such."""
    if min_words < HEAD + SPREAD - 1:
        raise ValueError(f"min_words has to be at least {HEAD + SPREAD - 1}")
    runs = shared_runs(docs, min_words)
    low, high = F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    repeated = runs.groupBy("run").agg(low, high).where("low <> high").select("run", "low")
    met = stored(runs.join(repeated, "run"), "met")
    later = met.where("doc_id <> low")
    # The first document of a run meets the second one.
    second = later.groupBy("run").agg(F.min("doc_id").alias("other"))
    first = met.where("doc_id = low").join(second, "run")
    place = ["doc_id", "pos", "end", "first_char", "last_char"]
    return first.select(*place, "other").union(later.select(*place, F.col("low").alias("other")))


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, first_word, n_words, first_char, last_char, with_doc, seen_before`` of repeated passages.

    A passage is a run of at least ``min_words`` words (between ASCII blanks, A-Z in lower case) that stands
    in another document as well. Overlapping passages of a document are one row; ``with_doc`` is the
    smallest other document that holds ``min_words`` words of it and ``seen_before`` whether that is smaller
    than ``doc_id``. The place is given in words and in characters of the original text.

    Method: of every text only suffixes at minimisers of HEAD-word hashes are kept, about one in thirteen
    words. A cell is the words of all runs of ``min_words`` words that keep the same suffix. Heads that stand in
    several documents pick, in a second scan, the cells that may be repeated: a cell whole where its head
    has no other, else each of its runs, by the hash of all its words. Equal ones meet by groups with map-side
    combining, whatever the number of documents or of places in one document, and overlapping ones are joined.
    No pair of documents is made and none is left out.

    Edge cases: null, empty and shorter texts have no passage; a passage repeated only inside one
    document is not reported; rows without ``doc_id`` are left out; rows that repeat a ``doc_id`` are the same
    document; equal documents are one passage each; an empty table gives no rows; other columns are ignored.
    """
    own = Window.partitionBy("doc_id").orderBy("pos", "end")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("pos") > before).cast("int"), F.lit(0))
    marked = repeated_runs(docs, min_words).withColumn("opens", opens).withColumn("passage", F.sum("opens").over(own))
    merged = marked.groupBy("doc_id", "passage").agg(
        F.min("pos").cast("long").alias("first_word"),
        F.max("end").cast("long").alias("last_word"),
        F.min("first_char").cast("long").alias("first_char"),
        F.max("last_char").cast("long").alias("last_char"),
        F.min("other").alias("with_doc"),
    )
    return merged.select(
        "doc_id",
        "first_word",
        (F.col("last_word") - F.col("first_word")).alias("n_words"),
        "first_char",
        "last_char",
        "with_doc",
        (F.col("with_doc") < F.col("doc_id")).alias("seen_before"),
    )
