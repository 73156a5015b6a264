"""Hard negatives of anchor vectors by a vertical scan of dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import in_batches
from textloom.session import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# A negative scores at least LOW and at most HIGH hundredths of its positive.
LOW, HIGH = 50, 95
# Bytes of vectors in one block of rows and in one block of anchors.
BLOCK_BYTES, ANCHOR_BYTES = 2 << 20, 256 << 10
# Blocks of rows and blocks of anchors in one partition, at most; a task meets one partition of each.
GROUP_BLOCKS, GROUP_ANCHORS = 64, 128
# Dimensions read between two looks at the bounds; the last number is repeated.
READS = (8, 8, 16, 32)
# Scaled components stay below this, so that they are whole numbers of 64 bits.
MOST = float(1 << 62)

BLOCK = "block long, dim int, low_label long, high_label long, keys binary, ids binary, labels binary, columns binary"
POSITIVE = "block long, anchor long, anchor_id long, positive_id long, positive_score long"
NEGATIVE = (
    "anchor long, place int, anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
)


def scaled_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``key, vec_id, label, vector`` of the rows that take part, stored: components floor(256 x) as longs."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    floor = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    held = F.forall(vector, lambda x: F.abs(x.cast("double") * SCALE) < MOST)
    whole = F.when(held, floor).otherwise(F.raise_error(F.lit("a component is too large")))
    kept = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite)
    return stored(
        kept.select(
            F.monotonically_increasing_id().alias("key"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            whole.alias("vector"),
        ),
        "vectors",
    )


def vector_blocks(vectors: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of vectors of one dimension, stored; ``columns`` holds them dimension by dimension.

    Rows are dealt by ranges of label and id, so a block holds few labels and a label of any size fills many
    blocks in many tasks.
    """

    def block(dim: int, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        keys, ids, labels, matrix = (np.concatenate(part) for part in zip(*held))
        values = [keys, ids, labels, np.ascontiguousarray(matrix.T)]
        columns = [pa.array([0]), pa.array([dim], pa.int32()), pa.array([labels.min()]), pa.array([labels.max()])]
        columns += [pa.array([v.astype(np.int64).tobytes()], pa.binary()) for v in values]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCK.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            keys, ids, labels = (batch.column(i).to_numpy() for i in range(3))
            lists = batch.column(3)
            size, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
            begin = np.cumsum(size) - size
            for dim in np.unique(size).tolist():
                of_dim = np.flatnonzero(size == dim)
                matrix = flat[begin[of_dim][:, None] + np.arange(dim)].astype(np.int64)
                room = max(1, block_bytes // (8 * max(dim, 1)))
                while len(of_dim):
                    own = held.setdefault(dim, [])
                    free = room - sum(len(part[0]) for part in own)
                    own.append((keys[of_dim[:free]], ids[of_dim[:free]], labels[of_dim[:free]], matrix[:free]))
                    if len(of_dim) >= free:
                        yield block(dim, held.pop(dim))
                    of_dim, matrix = of_dim[free:], matrix[free:]
        for dim, rows in held.items():
            yield block(dim, rows)

    dealt = vectors.repartitionByRange("label", "vec_id", "key").select("key", "vec_id", "label", "vector")
    blocks = in_batches(dealt, pack, BLOCK)
    return stored(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")


class Vectors:
    """One row of a block table: keys, ids and labels, and the vectors by dimension."""

    def __init__(self, batch: pa.RecordBatch, i: int, prefix: str = ""):
        def column(name: str) -> np.ndarray:
            return np.frombuffer(batch.column(prefix + name)[i].as_buffer(), np.int64)

        self.keys, self.ids, self.labels = column("keys"), column("ids"), column("labels")
        self.columns = column("columns").reshape(-1, len(self.keys))
        self.low = self.columns.min(axis=1)
        self.high = self.columns.max(axis=1)


def exact_type(anchors: Vectors, rows: Vectors) -> type:
    """A number type that holds every partial score of two blocks exactly."""
    most = [[max(abs(int(a)), abs(int(b))) for a, b in zip(v.low, v.high)] for v in (anchors, rows)]
    bound = sum(a * b for a, b in zip(*most))
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object


def vertical_scan(
    anchor: np.ndarray,
    columns: np.ndarray,
    ends: tuple[np.ndarray, np.ndarray],
    alive: np.ndarray,
    wanted: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> tuple[np.ndarray, np.ndarray]:
    """Rows left of the bitmap ``alive`` and their scores.

    Dimensions are read from the greatest component of the anchor to the smallest. ``ends`` are the least and the
    greatest value of each dimension in the block; what they allow the unread dimensions to add bounds
    each score from below and above, and ``wanted`` says by these bounds which rows stay in the bitmap.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    sides = np.stack([anchor * ends[0], anchor * ends[1]])
    rest = [np.append(np.cumsum(side[order][::-1])[::-1], 0) for side in (sides.min(axis=0), sides.max(axis=0))]
    scores = np.zeros(columns.shape[1], columns.dtype)
    at, read, look = np.flatnonzero(alive), 0, 0
    while read < len(order) and len(at):
        dims = order[read : read + READS[min(look, len(READS) - 1)]]
        part = columns[dims] if len(at) == columns.shape[1] else columns[np.ix_(dims, at)]
        scores[at] += anchor[dims] @ part
        read, look = read + len(dims), look + 1
        keep = wanted(scores[at] + rest[0][read], scores[at] + rest[1][read])
        alive[at[~keep]] = False
        at = at[keep]
    return at, scores[at]


def kth_largest(values: np.ndarray, k: int):
    return np.sort(values)[-k]


def may_be_best(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows whose upper bound reaches the k-th lower bound."""

    def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return high >= kth_largest(low, k) if len(low) > k else np.ones(len(low), bool)

    return wanted


def may_fill(windows: list[tuple[int, int]], k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that may be among the ``k`` best of a window of scores."""

    def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for first, last in windows:
            meets = (high >= first) & (low <= last)
            sure = low[(low >= first) & (high <= last)]
            if len(sure) >= k:
                meets &= high >= kth_largest(sure, k)
            keep |= meets.astype(bool)
        return keep

    return wanted


def best_first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by id."""
    return np.array(sorted(range(len(scores)), key=lambda i: (-int(scores[i]), int(ids[i])))[:k], np.int64)


def block_pairs(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each block of anchors beside each block of rows of its dimension.

    Both sides are dealt into partitions of bounded size, and a task reads one of each: nothing is copied, and no
    side is ever sent to the driver to be broadcast. A pair is a few hundred kB that take a task a tenth of a second or more.
    """
    count = blocks.count()
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(count, max(4 * cores, -(-count // GROUP_BLOCKS))))
    # The side on the right is held in memory by the task, so it is the one with the smaller partitions.
    dealt = anchors.repartition(max(1, -(-anchors.count() // GROUP_ANCHORS)))
    return blocks.repartition(groups).join(dealt.hint("shuffle_replicate_nl"), "dim")


def as_anchors(blocks: DataFrame) -> DataFrame:
    names = {name: f"a_{name}" for name in blocks.columns if name != "dim"}
    return blocks.withColumnsRenamed(names)


def nearest_positives(anchors: DataFrame, blocks: DataFrame, k: int = POSITIVES) -> DataFrame:
    """``block, anchor, anchor_id, place, positive_id, positive_score``: the ``k`` best other rows of an anchor's label, stored."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, rows = Vectors(batch, i, "a_"), Vectors(batch, i)
                kind = exact_type(own, rows)
                columns, ends = rows.columns.astype(kind), (rows.low.astype(kind), rows.high.astype(kind))
                found: list[tuple] = []
                for j in range(len(own.keys)):
                    alive = (rows.labels == own.labels[j]) & (rows.keys != own.keys[j])
                    at, scores = vertical_scan(own.columns[:, j].astype(kind), columns, ends, alive, may_be_best(k))
                    for x in best_first(scores, rows.ids[at], k).tolist():
                        found.append((own.keys[j], own.ids[j], rows.ids[at[x]], int(scores[x])))
                names = ["block", "anchor", "anchor_id", "positive_id", "positive_score"]
                values = list(zip(*found)) or [()] * 4
                block = [batch.column("a_block")[i].as_py()] * len(found)
                columns = [pa.array(v, pa.int64()) for v in (block, *values)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    pairs = block_pairs(as_anchors(anchors), blocks)
    pairs = pairs.where((F.col("a_low_label") <= F.col("high_label")) & (F.col("low_label") <= F.col("a_high_label")))
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    found = in_batches(pairs, search, POSITIVE).withColumn("place", F.row_number().over(order))
    return stored(found.where(F.col("place") <= k), "positives")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of all anchors.

    ``vectors`` holds ``vec_id, label, embedding``; ``is_anchor`` is a condition on ``vec_id`` and ``label``. Components
    become floor(256 x); a score is the inner product of two rows, higher first, ties to the smaller ``vec_id``. An
    anchor's positives are its first ``positives`` other rows of its label. For each, the first ``negatives`` rows of
    other labels that score between ``low`` and ``high`` hundredths of the positive are returned.

    Method: rows lie in blocks by dimension. For each anchor the dimensions of a block are read by descending
    magnitude of the anchor's component. The least and greatest values of the unread dimensions bound what
    can be added, and rows that can no longer be among the best, or in a window of scores, leave the bitmap of
    candidates before the next read. Positives are found first; their scores set the windows of the second scan.
    All blocks are scanned and every bound is exact, so nothing is lost.

    Edge cases: rows with a null label, vector or ``vec_id``, or a null or non-finite component, take no part; vectors
    of other length than the anchor's are not compared with it; every row of a repeated ``vec_id`` is a row of its
    own, also as anchor; an anchor without positive gives no rows; a positive score below 1 leaves at most
    equal scores of 0; an empty table gives no rows; other columns are ignored. A component of 2^54 or a score
    beyond 64 bits ends the job.
    """
    rows = scaled_vectors(vectors)
    anchors = vector_blocks(rows.where(is_anchor), ANCHOR_BYTES)
    blocks = vector_blocks(rows, BLOCK_BYTES)
    best = nearest_positives(anchors, blocks, positives)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, rows = Vectors(batch, i, "a_"), Vectors(batch, i)
                kind = exact_type(own, rows)
                columns, ends = rows.columns.astype(kind), (rows.low.astype(kind), rows.high.astype(kind))
                known: dict[int, list[dict]] = {}
                for p in batch.column("a_positives")[i].as_py():
                    known.setdefault(p["anchor"], []).append(p)
                found: list[tuple] = []
                for j, key in enumerate(own.keys.tolist()):
                    limits = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in known.get(key, [])]
                    windows = sorted({w for w in limits if w[0] <= w[1]})
                    if not windows:
                        continue
                    alive = rows.labels != own.labels[j]
                    vector = own.columns[:, j].astype(kind)
                    at, scores = vertical_scan(vector, columns, ends, alive, may_fill(windows, negatives))
                    for p, (first, last) in zip(known[key], limits):
                        inside = np.flatnonzero((scores >= first) & (scores <= last))
                        for x in inside[best_first(scores[inside], rows.ids[at[inside]], negatives)].tolist():
                            found.append((
                                key, p["place"], own.ids[j], p["positive_id"], rows.ids[at[x]],
                                p["positive_score"], int(scores[x]),
                            ))
                fields = [f.split() for f in NEGATIVE.split(", ")]
                values = list(zip(*found)) or [()] * len(fields)
                kinds = {"int": pa.int32(), "long": pa.int64()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, kinds[kind]) for v, (_, kind) in zip(values, fields)], names=[f[0] for f in fields]
                )

    # At most ``positives`` for each anchor of a block.
    of_block = best.groupBy(F.col("block").alias("a_block")).agg(
        F.collect_list(F.struct("anchor", "place", "positive_id", "positive_score")).alias("a_positives")
    )
    # Merged, since a broadcast would bring the positives of all anchors to the driver.
    asked = stored(as_anchors(anchors).join(of_block.hint("merge"), "a_block"), "asked")
    pairs = block_pairs(asked, blocks)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    found = in_batches(pairs, search, NEGATIVE).withColumn("rank", F.row_number().over(order))
    return found.where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
