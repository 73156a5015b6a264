"""Toxicity scores by a convolutional classifier over hashed words, trained in numpy on the executors."""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import ALNUM_WORDS, DRAW_BITS, arrow_text, hash_words, in_batches, slabs
from textloom.operators.joins import lookup_join
from textloom.session import stored

# Labelled rows are dealt into shards of about so many, trained beside each other; a block of a shard holds at most so many bytes.
SHARD_ROWS, BLOCK_BYTES = 4096, 16 << 20
# One labelled row in so many is kept for the thresholds.
HELD_SHARE = 5
# Slices of the table in which the changes of all shards are added up.
SLICES = 16
# Scores are counted in so many steps to set thresholds.
SCORE_STEPS = 1 << 16
# A word is the sum of table rows for the whole word and for its first bytes, so that inflected forms
# share what is learned about their stem.
PREFIXES = (5, 4)
ROWS = 1 + len(PREFIXES)
TABLE_BITS, DIM = 17, 8
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH_DOCS = 6, 32
# A small table of labels is gone through more often, until it has made so many steps.
LEAST_STEPS = 1000
CHUNK = 1 << 15
THRESHOLD = 0.3
SEED = 11


def word_rows(hashes: np.ndarray) -> np.ndarray:
    """The table rows of each word."""
    return (hashes & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int32)


def text_words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Table rows of the words of consecutive texts, and the words before each text, slab by slab."""
    for a, b in slabs(offsets):
        hashes, _, _, before = hash_words(data, offsets[a : b + 1], ALNUM_WORDS, PREFIXES)
        yield word_rows(hashes), before


@dataclass
class ToxicityModel:
    table: np.ndarray
    kernels: list[np.ndarray]
    shift: np.ndarray
    dense: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = THRESHOLD

    def pool(self, words: np.ndarray, bounds: np.ndarray, places: bool = False):
        """Largest answer of each filter over all windows of each text; windows end in empty words.

        Answers are at least 0, also for texts without words. Windows are taken chunk by chunk, so a long
        text needs no more memory than a short one. With ``places`` also the window of each maximum.
        """
        rows, widest = len(bounds) - 1, max(WIDTHS)
        pooled = np.zeros((rows, len(WIDTHS) * FILTERS), np.float32)
        where = np.full(pooled.shape, -1, np.int64) if places else None
        text_of = np.repeat(np.arange(rows), np.diff(bounds))
        for begin in range(0, len(words), CHUNK):
            end = min(begin + CHUNK, len(words))
            reach = min(end + widest - 1, len(words))
            vectors = np.zeros((end - begin + widest - 1, DIM), np.float32)
            for column in range(ROWS):
                vectors[: reach - begin] += self.table[words[begin:reach, column]]
            own = text_of[begin:end]
            after = np.zeros(end - begin + widest - 1, np.int64) - 1
            after[: reach - begin] = text_of[begin:reach]
            answers = np.empty((end - begin, pooled.shape[1]), np.float32)
            for k, (width, kernel) in enumerate(zip(WIDTHS, self.kernels)):
                part = answers[:, k * FILTERS : (k + 1) * FILTERS]
                part[:] = self.shift[k * FILTERS : (k + 1) * FILTERS]
                for o in range(width):
                    vector = vectors[o : o + end - begin]
                    if o:
                        vector = np.where((after[o : o + end - begin] == own)[:, None], vector, 0)
                    part += vector @ kernel[o]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            texts = own[first]
            best = np.maximum.reduceat(answers, first, axis=0)
            better = best > pooled[texts]
            if places:
                lasts = np.append(first[1:], end - begin)
                for t, a, b, up in zip(texts, first, lasts, better):
                    if up.any():
                        where[t, up] = begin + a + answers[a:b, up].argmax(axis=0)
            pooled[texts] = np.maximum(pooled[texts], best)
        return (pooled, where) if places else pooled

    def score(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.pool(words, bounds) @ self.dense + self.bias)))


class _Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), np.zeros(1, np.float32), rate

    def step(self, value: np.ndarray, slope: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (slope - self.m)
        self.v += 0.001 * (slope * slope - self.v)
        value -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-7)


class Training:
    """A model together with what its training has to remember."""

    def __init__(self, prior: float, seed: int):
        rng = np.random.default_rng(seed)
        total = len(WIDTHS) * FILTERS
        # Small first values: a word that was never seen adds next to nothing.
        self.model = ToxicityModel(
            rng.normal(0, 0.01, (1 << TABLE_BITS, DIM)).astype(np.float32),
            [rng.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(total, np.float32),
            rng.normal(0, 0.3, total).astype(np.float32),
            0.0,
        )
        self.bias = np.array([np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))], np.float32)
        self.learners = [_Adam(k.shape, 0.005) for k in self.model.kernels]
        self.learners += [_Adam(total, 0.005), _Adam(total, 0.005), _Adam(1, 0.005)]
        self.squares = np.full(1 << TABLE_BITS, 1e-8, np.float32)

    def dense_parts(self) -> list[np.ndarray]:
        """All arrays but the table and its squares."""
        own = [*self.model.kernels, self.model.shift, self.model.dense, self.bias]
        return own + [x for learner in self.learners for x in (learner.m, learner.v, learner.t)]

    def epoch(self, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> None:
        """Go through the words of texts once. Only the windows that give a maximum are changed."""
        model, bias = self.model, self.bias
        *learners, learn_shift, learn_dense, learn_bias = self.learners
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH_DOCS):
            rows = order[i : i + BATCH_DOCS]
            words = np.concatenate([texts[r] for r in rows])
            bounds = np.concatenate([[0], np.cumsum([len(texts[r]) for r in rows])])
            pooled, where = model.pool(words, bounds, places=True)
            chance = 1 / (1 + np.exp(-(pooled @ model.dense + bias[0])))
            slope = ((chance - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            to_pool = slope[:, None] * model.dense[None, :] * (where >= 0)
            table_rows, table_slopes = [], []
            for k, (width, kernel) in enumerate(zip(WIDTHS, model.kernels)):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                text, filters = np.nonzero(where[:, part] >= 0)
                at, back = where[:, part][text, filters], to_pool[:, part][text, filters]
                kernel_slope = np.zeros_like(kernel)
                for o in range(width):
                    inside = at + o < bounds[text + 1]
                    p, f, g = (at + o)[inside], filters[inside], back[inside]
                    vector = model.table[words[p]].sum(axis=1)
                    np.add.at(kernel_slope[o].T, f, vector * g[:, None])
                    for column in range(ROWS):
                        table_rows.append(words[p, column])
                        table_slopes.append(kernel[o].T[f] * g[:, None])
                learners[k].step(kernel, kernel_slope)
            learn_shift.step(model.shift, to_pool.sum(axis=0))
            learn_dense.step(model.dense, pooled.T @ slope)
            learn_bias.step(bias, slope.sum(keepdims=True))
            touched, inverse = np.unique(np.concatenate(table_rows), return_inverse=True)
            step = np.zeros((len(touched), DIM), np.float32)
            np.add.at(step, inverse, np.concatenate(table_slopes))
            self.squares[touched] += (step * step).mean(axis=1)
            model.table[touched] -= 0.05 * step / np.sqrt(self.squares[touched])[:, None]

    def finished(self) -> ToxicityModel:
        self.model.bias = float(self.bias[0])
        return self.model


def epochs_of(rows: float) -> int:
    """How often so many rows are gone through."""
    return max(EPOCHS, -(-LEAST_STEPS // max(1, int(-(-rows // BATCH_DOCS)))))


def prior_weight(labels: np.ndarray, prior: float) -> np.ndarray:
    share = labels.mean() if len(labels) else 0.5
    return np.where(labels == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))


def fit_network(texts: list[np.ndarray], labels: np.ndarray, prior: float, seed: int = SEED) -> ToxicityModel:
    """Train on the words of texts, given by their table rows.

    Rows are weighted so that toxic ones make up ``prior`` of the loss, whatever their share in the sample;
    scores are then probabilities in the corpus.
    """
    training, rng, weight = Training(prior, seed), np.random.default_rng(seed), prior_weight(labels, prior)
    for _ in range(epochs_of(len(texts))):
        training.epoch(texts, labels, weight, rng)
    return training.finished()


SHARD = "shard long, words binary, sizes binary, toxic binary"
CHANGE = "slice int, shard long, rows binary, change binary"


def shard_blocks(rows: DataFrame, shards: int) -> DataFrame:
    """Blocks of the rows (``shard, draw, toxic, words``) of each shard in a fixed order, stored."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int]] = []
        last, size, begun = None, 0, 0

        def block() -> pa.RecordBatch:
            words = [w for w, _ in held]
            values = [b"".join(words), np.array([len(w) // 8 for w in words], np.int64).tobytes(), bytes(t for _, t in held)]
            # Blocks of one shard have numbers of their own.
            number = last + begun * shards
            columns = [pa.array([number], pa.int64()), *(pa.array([v], pa.binary()) for v in values)]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "words", "sizes", "toxic"])

        for batch in batches:
            for shard, toxic, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and (shard != last or size >= BLOCK_BYTES):
                    yield block()
                    begun = begun + 1 if shard == last else 0
                    held, size = [], 0
                last = shard
                held.append((words, toxic))
                size += len(words)
        if held:
            yield block()

    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "draw", "toxic", "words")
    return stored(in_batches(dealt.select("shard", "toxic", "words"), pack, SHARD), "toxicity-shards")


def fit_shards(blocks: DataFrame, prior: float, epochs: int, seed: int) -> ToxicityModel:
    """Train on all rows of all blocks.

    In each round every block is gone through once, starting from the same state; then the changes are averaged, those of
    a table row over the blocks that changed it. Changes are added up slice by slice on the executors, so the driver gets one
    model, however many blocks there are. A single block is trained without rounds, as by ``fit_network``.
    """
    training, spark = Training(prior, seed), blocks.sparkSession
    single = blocks.count() == 1
    slots = (1 << TABLE_BITS) // SLICES

    def shared(state: Training, number: int, epochs: int):
        sent = spark.sparkContext.broadcast(state)

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, words, sizes, toxic in zip(*(batch.column(i) for i in range(4))):
                    shard, own = shard.as_py(), copy.deepcopy(sent.value)
                    packed = np.frombuffer(words.as_buffer(), np.int64)
                    rows = np.empty((len(packed), ROWS), np.int32)
                    for c in range(ROWS):
                        rows[:, c] = (packed >> (TABLE_BITS * c)) & ((1 << TABLE_BITS) - 1)
                    ends = np.cumsum(np.frombuffer(sizes.as_buffer(), np.int64))
                    texts = np.split(rows, ends[:-1])
                    labels = np.frombuffer(toxic.as_buffer(), np.uint8).astype(np.float32)
                    rng = np.random.default_rng(seed if single else [seed, shard, number])
                    # All blocks together have about the share of toxic rows that all labels have.
                    weight = prior_weight(labels, prior) if single else np.ones(len(labels), np.float32)
                    for _ in range(epochs):
                        own.epoch(texts, labels, weight, rng)
                    start = sent.value
                    changed = np.flatnonzero(own.squares != start.squares)
                    change = np.concatenate([own.model.table - start.model.table, (own.squares - start.squares)[:, None]], axis=1)
                    cuts = np.searchsorted(changed, np.arange(SLICES + 1) * slots)
                    rows = [changed[x:y] for x, y in zip(cuts[:-1], cuts[1:])]
                    dense = np.concatenate([(x - y).ravel() for x, y in zip(own.dense_parts(), start.dense_parts())])
                    parts = [(k, (r - k * slots).astype(np.int32), change[r]) for k, r in enumerate(rows)]
                    parts.append((SLICES, np.zeros(0, np.int32), dense))
                    columns = [
                        pa.array([k for k, _, _ in parts], pa.int32()), pa.array([shard] * len(parts), pa.int64()),
                        *(pa.array([p[i].tobytes() for p in parts], pa.binary()) for i in (1, 2)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["slice", "shard", "rows", "change"])

        return train, sent

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, times = None, None, None

        def summed() -> pa.RecordBatch:
            mean = (total / np.maximum(times, 1)[:, None]).astype(np.float32)
            columns = [pa.array([last], pa.int32()), pa.array([0], pa.int64()), pa.array([b""], pa.binary()), pa.array([mean.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["slice", "shard", "rows", "change"])

        for batch in batches:
            for k, rows, change in zip(*(batch.column(i) for i in (0, 2, 3))):
                k, change = k.as_py(), np.frombuffer(change.as_buffer(), np.float32)
                if k != last:
                    if last is not None:
                        yield summed()
                    last, width = k, DIM + 1 if k < SLICES else len(change)
                    total, times = np.zeros((slots if k < SLICES else 1, width)), np.zeros(slots if k < SLICES else 1, np.int64)
                at = np.frombuffer(rows.as_buffer(), np.int32) if k < SLICES else np.zeros(1, np.int32)
                total[at] += change.reshape(len(at), -1)
                times[at] += 1
        if last is not None:
            yield summed()

    for number in range(1 if single else epochs):
        train, sent = shared(training, number, epochs if single else 1)
        changes = in_batches(blocks, train, CHANGE)
        dealt = changes.repartition(SLICES, "slice").sortWithinPartitions("slice", "shard")
        found = in_batches(dealt, add_up, CHANGE).select("slice", "change").toArrow()
        for k, change in zip(found["slice"].to_pylist(), found["change"]):
            change = np.frombuffer(change.as_buffer(), np.float32)
            if k < SLICES:
                change = change.reshape(slots, DIM + 1)
                training.model.table[k * slots : (k + 1) * slots] += change[:, :DIM]
                training.squares[k * slots : (k + 1) * slots] += change[:, DIM]
                continue
            at = 0
            for part in training.dense_parts():
                part += change[at : at + part.size].reshape(part.shape)
                at += part.size
        sent.destroy()
    return training.finished()


def best_threshold(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The score from which on flagging gives the best F1."""
    if not labels.any() or labels.all():
        return THRESHOLD
    order = np.argsort(-scores, kind="stable")
    hit, flagged = np.cumsum((labels * weight)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (flagged + (labels * weight).sum())
    # A threshold stands between two different scores.
    ranked = scores[order]
    ends = np.append(ranked[1:] != ranked[:-1], True)
    best = int(np.where(ends, f1, -1).argmax())
    below = ranked[best + 1] if best + 1 < len(ranked) else 0.0
    return float((ranked[best] + below) / 2)


def fit_toxicity(docs: DataFrame, labels: DataFrame, min_calibration_rows: int = 50, seed: int = SEED) -> ToxicityModel:
    """Fit on all ``doc_id, toxic`` labels and set a threshold per language.

    Four fifths of the rows, dealt by a hash of their id, train the network in shards beside each other (``fit_shards``). The
    other fifth sets the thresholds: the best F1 for each language with enough rows, and for all together; for that,
    scores are counted in steps of ``1 / SCORE_STEPS``. The language is used for thresholds alone, never for a score.
    """
    known = labels.where("toxic is not null and doc_id is not null")
    rows = known.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, negative = totals.get(1, 0), totals.get(0, 0)
    if not positive or not negative:
        empty = fit_network([], np.zeros(0), 0.5, seed)
        empty.bias = 10.0 if positive else -10.0
        empty.dense[:] = 0
        return empty
    trained = (positive + negative) * (1 - 1 / HELD_SHARE)
    shards = int(-(-trained // SHARD_ROWS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrow_text(batch.column(0))
            words = []
            for rows, before in text_words(data, offsets):
                packed = sum(rows[:, c].astype(np.int64) << (TABLE_BITS * c) for c in range(ROWS))
                words += [packed[x:y].tobytes() for x, y in zip(before[:-1], before[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *batch.columns[1:]], names=["words", *batch.schema.names[1:]])

    texts = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    drawn = lookup_join(texts, rows, "doc_id")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 64 - DRAW_BITS)
    drawn = drawn.withColumn("draw", draw).withColumn("held", F.shiftright("draw", 20) % HELD_SHARE == HELD_SHARE - 1)
    learnt = in_batches(drawn.where(~F.col("held")).select("text", "toxic", "draw"), cut, "words binary, toxic int, draw long")
    blocks = shard_blocks(learnt.withColumn("shard", F.col("draw") % shards), shards)
    prior = positive / (positive + negative)
    model = fit_shards(blocks, prior, epochs_of(trained), seed)

    counts = score_toxicity(drawn.where("held"), model, ("toxic", "lang"))
    step = F.least(F.floor(F.col("score") * SCORE_STEPS), F.lit(SCORE_STEPS - 1)).alias("step")
    found = counts.groupBy("lang", "toxic", step).agg(F.count(F.lit(1)).alias("n")).orderBy("step", "toxic", "lang").toArrow()
    if found.num_rows:
        scores, n = (found["step"].to_numpy() + 0.5) / SCORE_STEPS, found["n"].to_numpy().astype(np.float64)
        y, lang = found["toxic"].to_numpy().astype(np.float64), np.array(found["lang"].to_pylist(), object)
        model.threshold = best_threshold(scores, y, n)
        for name in sorted({x for x in lang if x is not None}):
            own = lang == name
            if n[own].sum() >= min_calibration_rows and y[own].any():
                model.thresholds[name] = best_threshold(scores[own], y[own], n[own])
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, others: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, flagged`` of every row of ``doc_id, text, lang``, and the columns named by ``others``.

    ``score`` is the probability of label 1, from the whole text alone. ``flagged`` compares it with the threshold
    of the row's language, or the common one where a language has none or is null.

    Edge cases: null and empty texts get the score of a text without words; repeated rows give repeated
    results; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = arrow_text(batch.column(1))
            scores = [np.zeros(0)]
            for rows, before in text_words(data, offsets):
                scores.append(model.score(rows, before))
            scores = np.concatenate(scores).astype(np.float64)
            limits = [model.thresholds.get(x, model.threshold) for x in batch.column(2).to_pylist()]
            columns = [batch.column(0), pa.array(scores), pa.array(scores >= np.array(limits, np.float64)), *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "flagged", *others])

    kept = [F.col(name).alias(f"other_{i}") for i, name in enumerate(others)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"), *kept)
    types = "".join(f", {name} {docs.schema[name].dataType.simpleString()}" for name in others)
    return rows.mapInArrow(score, "doc_id long, score double, flagged boolean" + types)
