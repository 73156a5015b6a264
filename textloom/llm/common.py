"""Helpers shared by the operators of this folder: word hashes in numpy, Arrow texts, components."""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Texts are hashed in slabs of about this many bytes, which bounds the arrays a task holds.
SLAB_BYTES = 1 << 19
# Bytes of one Arrow batch between the JVM and a Python worker, where Spark would fill 64 MB.
BATCH_BYTES = 4 << 20
# Bits of the hash that draws a sample; few enough to be exact as a share of one.
DRAW_BITS = 52

# Word hashes are values of a polynomial modulo the prime 2^61 - 1, so equal low bits of a sum do not cancel.
_PRIME = (1 << 61) - 1
_BASE = 0x9E3779B97F4A7C15 % _PRIME
_M = np.uint64(_PRIME)
# Runs of more values than this would pass 64 bits in a partial sum and are hashed by a digest.
LONGEST_RUN = 1 << 22
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(text: Column) -> Column:
    """Text with A-Z in lower case and nothing else changed; null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def byte_table(separators: bytes) -> np.ndarray:
    """Lookup of 256 bytes: lower case for A-Z, 0 for separators, each other byte as it is.

    Byte 0 as part of a word would look like a separator, so it is written as 255, which UTF-8
    never holds.
    """
    lookup = np.arange(256, dtype=np.uint8)
    lookup[0] = 255
    lookup[65:91] += 32
    lookup[list(separators)] = 0
    return lookup


BLANKS = bytes([0x20, *range(0x09, 0x0E)])
BLANK_WORDS = byte_table(BLANKS)
# Words of ASCII letters, digits and every byte outside ASCII.
ALNUM_WORDS = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _low61(x: np.ndarray) -> np.ndarray:
    x = (x & _M) + (x >> np.uint64(61))
    return np.where(x >= _M, x - _M, x)


def _shifted(x: np.ndarray) -> np.ndarray:
    """``x * 2^32`` modulo the prime, below 2^62."""
    x = _low61(x)
    return ((x & np.uint64((1 << 29) - 1)) << np.uint64(32)) + (x >> np.uint64(29))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it."""
    half, low = np.uint64(32), np.uint64((1 << 32) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    return _low61(_low61((a1 * b1) << np.uint64(3)) + _shifted(a1 * b0 + a0 * b1) + _low61(a0 * b0))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Low 32 bits and rest of the first ``n`` powers of the base, and the powers of its inverse."""
    if not _powers or len(_powers["low"]) < n:
        size = -(-n // (1 << 16)) << 16
        tables = []
        for base in (_BASE, pow(_BASE, -1, _PRIME)):
            powers = np.ones(1, np.uint64)
            while len(powers) < size:
                powers = np.concatenate([powers, times(powers, np.uint64(pow(base, len(powers), _PRIME)))])
            tables.append(powers[:size].copy())
        _powers.update(low=tables[0] & np.uint64((1 << 32) - 1), high=tables[0] >> np.uint64(32), inverse=tables[1])
    return _powers["low"], _powers["high"], _powers["inverse"]


class RunHasher:
    """64-bit hashes of runs of an array of bytes; equal runs have equal hashes wherever they stand."""

    def __init__(self, values: np.ndarray):
        self.values, n = values, len(values)
        low, high, self.inverse = power_tables(n + 1)
        wide = values.astype(np.uint64)
        wide += np.uint64(1)
        self.low, self.high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        # In place: fewer large arrays at once and less to allocate.
        for powers, sums in ((low, self.low[1:]), (high, self.high[1:])):
            np.multiply(wide, powers[:n], out=sums)
            np.cumsum(sums, out=sums)

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the values from ``first`` to before ``last``, for each pair of places."""
        total = _low61(_low61(self.low[last] - self.low[first]) + _shifted(self.high[last] - self.high[first]))
        size = (last - first).astype(np.uint64)
        hashes = mix(times(total, self.inverse[first]) + (size << np.uint64(1)))
        for i in np.flatnonzero(size > LONGEST_RUN).tolist():
            digest = hashlib.blake2b(self.values[first[i] : last[i]].tobytes(), digest_size=8).digest()
            hashes[i] = np.frombuffer(digest, np.uint64)[0]
        return hashes


def arrow_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column, without copying; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), offsets


def give_back() -> None:
    """Return freed memory to the system. A Python worker outlives its task, and the C library would keep it."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def giving_back(fn: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``fn`` that gives freed memory back after each batch it returns and at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fn(batches):
            yield batch
            del batch
            give_back()
        give_back()

    return run


def in_batches(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` over batches of about BATCH_BYTES; a longer row is a batch of its own.

    Memory that a batch leaves free goes back to the system, so idle workers are small. Frames run after they are made, so the bound is set for the session and stays; a smaller one is kept.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    current = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if current > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(giving_back(fn), schema)


def slabs(offsets: np.ndarray, size: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def hash_words(data: np.ndarray, offsets: np.ndarray, lookup: np.ndarray, prefixes: tuple[int, ...] = ()):
    """Hashes of all words of consecutive texts.

    Returns the 64-bit hash, first and last-plus-one byte of each word (relative to the first text)
    and, per text, the number of words before it. Words never span two texts. With ``prefixes`` the hashes
    have a further column for the first so many bytes of each word.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    folded = lookup[data[lo:hi]]
    n, rows = len(folded), len(offsets) - 1
    bounds = offsets - lo
    if n == 0:
        empty = np.zeros(0, np.int64)
        shape = (0, 1 + len(prefixes)) if prefixes else 0
        return np.zeros(shape, np.uint64), empty, empty, np.zeros(rows + 1, np.int64)
    inside = folded != 0
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    run = RunHasher(folded)
    hashes = run(first, last)
    if prefixes:
        hashes = np.stack([hashes, *(run(first, np.minimum(first + size, last)) for size in prefixes)], axis=1)
    return hashes, first, last, np.searchsorted(first, bounds, "left")


_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; ``words`` holds at least ``k`` word hashes."""
    n = len(words) - k + 1
    total = np.zeros(n, np.uint64)
    for i in range(k):
        # The shift brings high bits down, so sums of long patterned runs do not cancel.
        total = (total ^ (total >> np.uint64(29))) * _STEP + words[i : i + n]
    return mix(total)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``id, component``: the smallest id reachable from each id of ``edges`` (``a``, ``b`` longs).

    Large-star and small-star steps in turn until no edge changes. Each step groups by a node with
    map-side combining and joins the minimum back, so the edges of one node are never gathered.
    Every step is written to the shared folder, which cuts the lineage.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), label)
    seen = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of each node are tied to the smallest node around it.
        up = edges.select(F.col("a").alias("u"), F.col("b").alias("a")).join(low, "a")
        large = up.select(F.col("u").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, label)
        # Smaller neighbours and the node itself are tied to the smallest of them.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down)
        edges = stored(small.toDF("a", "b").where("a <> b").distinct(), label)
        mark = edges.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 7L))")
        ).first()
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


# --- passing only rows whose id may be wanted ----------------------------------------------------

FILTER_BITS = 23


def id_slot(column: Column) -> Column:
    """Place of an id in a filter of 2^FILTER_BITS bits."""
    return F.xxhash64(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """Bit set over the ids of a column, of fixed size (1 MB) however many ids there are.

    It only spares rows that cannot be wanted; callers join with the ids afterwards.
    """
    slot = id_slot(F.col(column))
    word, bit = F.shiftrightunsigned(slot, 5), slot.bitwiseAND(F.lit(31)).cast("int")
    words = ids.select(word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit")).groupBy("word", "bit").count()
    rows = words.select("word", "bit").groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    found = rows.toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out


def in_filter(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 5] >> (slots & 31).astype(np.uint32)) & np.uint32(1) == 1
