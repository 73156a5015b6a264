"""Best-fit packing of documents into fixed-length sequences after dominance reduction."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import arrow_text, in_batches
from textloom.llm.tokenize import END_ID, encoder
from textloom.session import stored

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
RUN = np.dtype([("length", "i8"), ("first", "i8"), ("bin", "i8"), ("per_bin", "i8"), ("offset", "i8")])


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens: only longer ones are cut, short piece first."""
    short, whole = n % capacity, n // capacity
    return ([short] if short else []) + [capacity] * whole


class _Plan:
    """Items of equal length are interchangeable, so the plan is made over counts by length.

    A run gives ``count`` items of one length to consecutive bins, ``per_bin`` to each. Its number of
    runs depends on the capacity, not on the number of items.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.taken = np.zeros(capacity + 1, np.int64)
        self.bins = 0
        self.fixed_bins = 0
        self.runs: list[tuple[int, int, int, int, int]] = []

    def take(self, length: int, items: int, first_bin: int, per_bin: int, offset: int) -> None:
        self.runs.append((length, int(self.taken[length]), first_bin, per_bin, offset))
        self.taken[length] += items
        self.left[length] -= items

    def fix(self, lengths: list[int], bins: int) -> None:
        """Permanently fill ``bins`` new bins with one item of each of ``lengths``."""
        if len(lengths) == 2 and lengths[0] == lengths[1]:
            self.take(lengths[0], 2 * bins, self.bins, 2, 0)
        else:
            offset = 0
            for length in lengths:
                self.take(length, bins, self.bins, 1, offset)
                offset += length
        self.bins += bins

    def _smallest(self, j: int, n: int) -> list[int]:
        """The ``n`` smallest lengths left beside one item of length ``j``."""
        found: list[int] = []
        for s in np.flatnonzero(self.left).tolist():
            found += [s] * min(n - len(found), int(self.left[s]) - (s == j))
            if len(found) == n:
                break
        return found

    def _best_pair(self, j: int, room: int) -> int:
        """Largest sum of two items other than one of length ``j`` that fits into ``room``."""
        lengths = [s for s in np.flatnonzero(self.left[: room + 1]).tolist() if self.left[s] > (s == j)]
        best, a, b = 0, 0, len(lengths) - 1
        while a <= b:
            total = lengths[a] + lengths[b]
            if total > room or (a == b and self.left[lengths[a]] - (lengths[a] == j) < 2):
                b -= 1
            else:
                best, a = max(best, total), a + 1
        return best

    def reduce(self) -> None:
        """Fix the sets that dominate every other set of their largest item.

        For the largest item j with room r beside it: alone, if nothing fits; with k, the largest item
        that fits, if k fills r, if no two items fit into r, or if no three fit and no two
        that fit are larger than k together. In each case whatever stands beside j in an optimal packing
        can change places with k, so some optimal packing has this bin.
        """
        for j in range(self.capacity, 0, -1):
            while self.left[j]:
                room = self.capacity - j
                small = self._smallest(j, 3)
                if not small or small[0] > room:
                    self.fix([j], int(self.left[j]))
                    continue
                fitting = np.flatnonzero(self.left[: room + 1])
                k = int(fitting[-1])
                if k == j and self.left[j] < 2:
                    k = int(fitting[-2])
                bins = int(self.left[j] // 2 if k == j else min(self.left[j], self.left[k]))
                alone = len(small) < 2 or small[0] + small[1] > room
                if k == room or alone:
                    self.fix([j, k], bins)
                elif (len(small) < 3 or sum(small) > room) and k >= self._best_pair(j, room):
                    # Fewer items of length k change what fits, so the test is made for each bin anew
                    # only where k runs out.
                    self.fix([j, k], bins)
                else:
                    break
        self.fixed_bins = self.bins

    def best_fit(self) -> None:
        """Place the remaining items, longest first, into the fullest bin that still holds them."""
        room_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for s in range(self.capacity, 0, -1):
            for room in range(s, self.capacity + 1):
                if not self.left[s]:
                    break
                per = room // s
                if room == self.capacity:
                    bins = -(-int(self.left[s]) // per)
                    room_bins[room].append((self.bins, bins))
                    self.bins += bins
                while self.left[s] and room_bins[room]:
                    first, n = room_bins[room].pop()
                    full = min(n, int(self.left[s]) // per)
                    if full:
                        self.take(s, full * per, first, per, self.capacity - room)
                        room_bins[room - per * s].append((first, full))
                    rest = int(self.left[s])
                    if full < n and 0 < rest < per:
                        self.take(s, rest, first + full, rest, self.capacity - room)
                        room_bins[room - rest * s].append((first + full, 1))
                        full += 1
                    if full < n:
                        room_bins[room].append((first + full, n - full))


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int, int]:
    """Runs sorted by length and first rank, the number of bins, and how many the reduction fixed."""
    plan = _Plan(counts, capacity)
    plan.reduce()
    plan.best_fit()
    runs = np.array(plan.runs, RUN) if plan.runs else np.zeros(0, RUN)
    return np.sort(runs, order=["length", "first"]), plan.bins, plan.fixed_bins


def document_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of all documents with their task and their place among its pieces of one length, stored."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            rows = []
            texts = encode(*arrow_text(batch.column(1)))
            for doc_id, ids in zip(batch.column(0).to_pylist(), texts):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                start = 0
                for piece, length in enumerate(cut_lengths(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc_id, piece, start, length, crc, part, int(seen[length])))
                    seen[length] += 1
                    start += length
            columns = list(zip(*rows)) if rows else [()] * 7
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in PIECES.split(", ")]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(in_batches(rows, cut, PIECES), "pieces")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id, offset`` to stored pieces.

    The driver sees one count per length, at most ``capacity`` of them, and plans over these. A piece
    finds its run by its rank among the pieces of its length: the place inside its task plus the pieces
    of earlier tasks. The runs are broadcast; their number depends on ``capacity`` alone.
    """
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    counts = stored(counts.withColumn("before", before), "piece-counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _, _ = plan_packing(totals, capacity)
    keys = (runs["length"] << 40) | runs["first"]
    shared = pieces.sparkSession.sparkContext.broadcast((keys, runs))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, runs = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = runs[np.searchsorted(keys, (length << 40) | rank, "right") - 1]
            i = rank - run["first"]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns.append(pa.array(run["bin"] + i // run["per_bin"], pa.int64()))
            columns.append(pa.array(run["offset"] + i % run["per_bin"] * length, pa.int64()))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    ranked = pieces.join(counts.select("part", "length", "before"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return in_batches(ranked, place, schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document.

    A document is its token ids and ``end_id``. Longer ones than ``capacity`` are cut into pieces of that
    length, the first one holding the rest. Small sets of lengths that dominate all others are fixed
    first; the rest is packed best-fit, longest first. No text and no token is shuffled.

    Edge cases: a null or empty text is the end id alone; repeated rows are documents of their own;
    a null ``doc_id`` stays null; an empty table gives no rows; other columns are ignored.
    """
    return pack_pieces(document_pieces(docs, tokenizer_path, capacity, end_id), capacity)
