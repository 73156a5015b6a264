"""Benchmark decontamination: one Aho-Corasick scan of each text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ALNUM_WORDS, arrow_text, giving_back

WINDOW = 13
# Bytes of benchmark windows that one automaton holds; a larger benchmark is scanned in blocks.
BLOCK_BYTES = 64 << 20
_FOLD = bytes(int(b) if b else 32 for b in ALNUM_WORDS)
SCHEMA = "doc_id long, n_words long, hits array<struct<first: long, last: long>>, spans array<struct<first: long, last: long>>, items array<string>"

# The automaton last used by this Python worker.
_automata: dict[str, object] = {}


def normalise(text: bytes) -> bytes:
    """Words of a text in lower case, one blank before and after each."""
    return b" " + b" ".join(text.translate(_FOLD).split()) + b" "


def item_windows(item_id, text: str | None, window: int = WINDOW) -> list[tuple[str, str]]:
    """Normalised windows of one benchmark item; an item of fewer words is one window."""
    words = normalise((text or "").encode()).split()
    if not words:
        return []
    grams = [words[i : i + window] for i in range(max(1, len(words) - window + 1))]
    return [((b" " + b" ".join(g) + b" ").decode("latin-1"), str(item_id)) for g in grams]


def automaton(windows: list[tuple[str, str]]):
    """Aho-Corasick automaton whose matches name their number of words and their items."""
    import ahocorasick

    items: dict[str, set[str]] = {}
    for window, item in windows:
        items.setdefault(window, set()).add(item)
    built = ahocorasick.Automaton()
    for window, names in items.items():
        built.add_word(window, (window.count(" ") - 1, len(window), frozenset(names)))
    if items:
        built.make_automaton()
    return built


def merge(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges, in order."""
    out: list[list[int]] = []
    for first, last in sorted(pairs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(p) for p in out]


def scan(text: bytes, built) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]], list[str]]:
    """Words, hit word ranges, the same as byte ranges of the original text, and items of one text.

    The text is scanned once. Folding keeps every byte in its place, so the n-th word of the normalised
    text is the n-th word of the original.
    """
    words = normalise(text)
    count = words.count(b" ") - 1 if len(words) > 2 else 0
    if not count or not len(built):
        return count, [], [], []
    found = list(built.iter(words.decode("latin-1")))
    if not found:
        return count, [], [], []
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    ranges, items = [], set()
    for end, (n, size, names) in found:
        first = int(np.searchsorted(blanks, end - size + 1))
        ranges.append((first, first + n))
        items |= names
    hits = merge(ranges)
    inside = ALNUM_WORDS[np.frombuffer(text, np.uint8)] != 0
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    spans = [(int(begins[a]), int(ends[b - 1])) for a, b in hits]
    return count, hits, spans, sorted(items)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int) -> list[list[tuple[int, str]]]:
    """The items in blocks whose windows hold about ``block_bytes``.

    The benchmark is a set of test questions and answers, far smaller than the corpus; its size is
    measured before it is read.
    """
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size * WINDOW // block_bytes))
    keyed = rows.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    return [
        [(r["item_id"], r["text"]) for r in keyed.where(F.col("_block") == b).select("item_id", "text").collect()]
        for b in range(blocks)
    ]


def shared_windows(benchmark: DataFrame, window: int, block_bytes: int) -> list[tuple]:
    """Broadcast windows of each block, under a name of their own."""
    context = benchmark.sparkSession.sparkContext
    return [
        (uuid.uuid4().hex, context.broadcast([w for row in block for w in item_windows(*row, window)]))
        for block in benchmark_blocks(benchmark, block_bytes)
    ]


def search_texts(column: pa.Array, shared: list[tuple]) -> tuple[np.ndarray, list, list, list]:
    """Words, hit word ranges, their byte ranges and items of each text of an Arrow column."""
    data, offsets = arrow_text(column)
    raw, n = memoryview(data), len(column)
    counts = np.zeros(n, np.int64)
    hits, spans, items = [[] for _ in range(n)], [[] for _ in range(n)], [set() for _ in range(n)]
    for name, windows in shared:
        if name not in _automata:
            _automata.clear()
            _automata[name] = automaton(windows.value)
        built = _automata[name]
        for i in range(n):
            counts[i], h, s, names = scan(bytes(raw[offsets[i] : offsets[i + 1]]), built)
            hits[i] += h
            spans[i] += s
            items[i].update(names)
    return counts, hits, spans, items


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs``, with all columns, that are not contaminated; no row is shuffled."""
    shared = shared_windows(benchmark, window, block_bytes)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits, _, _ = search_texts(batch.column("text"), shared)
            n_hit = np.array([sum(b - a for a, b in merge(h)) for h in hits], np.int64)
            yield batch.filter(pa.array(~((n_hit > 0) & (20 * n_hit >= counts))))

    return docs.mapInArrow(giving_back(keep), docs.schema)


def contamination_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_words, hits, spans, items`` of every row of ``docs``.

    ``hits`` are merged ranges of word numbers inside any occurrence of a window, ``spans`` the same ranges
    as bytes of the original UTF-8 text, ``items`` the items that occur. Every text is scanned once by
    one automaton over all windows. A benchmark whose windows pass ``block_bytes`` is scanned block
    by block, so a worker never holds more than one automaton of that size.

    Edge cases: a null or empty text, or one without letters and digits, has no words and no hits;
    items without words have no windows; equal windows of several items count for each of them; repeated
    rows give repeated results; an empty benchmark hits nothing; other columns are ignored.
    """
    shared = shared_windows(benchmark, window, block_bytes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits, spans, items = search_texts(batch.column(1), shared)
            pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            as_pairs = lambda rows: [[{"first": a, "last": b} for a, b in merge(r)] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(as_pairs(hits), pair),
                    pa.array(as_pairs(spans), pair),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                names=["doc_id", "n_words", "hits", "spans", "items"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(search, SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans`` of every document.

    A document is contaminated if at least one word in twenty stands inside a window of the benchmark.
    """
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + h["last"] - h["first"])
    counted = contamination_hits(docs, benchmark, window).withColumn("n_hit", n_hit)
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "spans",
    )
