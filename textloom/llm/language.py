"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import DRAW_BITS, arrow_text, in_batches, slabs

UNKNOWN = "und"
# Bound of the labelled rows that classifiers are fitted on, over all languages together.
SAMPLE_ROWS = 3000
# Buckets of 1-, 2- and 3-byte grams.
BUCKETS = (256, 2048, 4096)
# Below this difference of losses, as a share of the whole bit weight, two languages are too close to tell.
MIN_MARGIN = 0.02
SEED = 7

# Letters in lower case and all bytes outside ASCII; everything else is a blank.
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Counts of hashed grams of each text, over its whole length."""
    for a, b in slabs(offsets):
        lo = int(offsets[a])
        raw = _FOLD[data[lo : int(offsets[b])]]
        grams = [raw]
        for size, buckets in zip((2, 3), BUCKETS[1:]):
            n = max(0, len(raw) - size + 1)
            total = np.zeros(n, np.uint32)
            for i in range(size):
                total += raw[i : i + n] * _FACTORS[i]
            total ^= total >> np.uint32(15)
            grams.append((total * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - buckets.bit_length() + 1))
        for i in range(a, b):
            first, last = int(offsets[i]) - lo, int(offsets[i + 1]) - lo
            yield np.concatenate(
                [
                    np.bincount(g[first : max(first, last - size)], minlength=buckets)
                    for g, size, buckets in zip(grams, range(3), BUCKETS)
                ]
            )


def as_features(counts: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies, each gram length on its own."""
    out = np.zeros(counts.shape, np.float32)
    begin = 0
    for buckets in BUCKETS:
        part = counts[:, begin : begin + buckets]
        out[:, begin : begin + buckets] = np.sqrt(part / np.maximum(part.sum(axis=1, keepdims=True), 1))
        begin += buckets
    return out


def codewords(n: int, seed: int = SEED) -> np.ndarray:
    """Code matrix of -1 and 1, one row per class.

    Up to seven classes have the exhaustive code: every way to split them in two. More have random words
    of ten bits per binary digit, the best of many draws by least distance between two rows.
    """
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 7:
        columns = [[1] + [1 if bits >> i & 1 else -1 for i in range(n - 1)] for bits in range((1 << (n - 1)) - 1)]
        return np.array(columns, np.int8).T
    rng = np.random.default_rng(seed)
    length, best, least = 10 * int(np.ceil(np.log2(n))), None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, length))
        code = code[:, np.abs(code.sum(axis=1 - 1)) < n]
        apart = (code.shape[1] - code.astype(np.int32) @ code.T.astype(np.int32)) // 2
        distance = int(apart[~np.eye(n, dtype=bool)].min())
        if distance > least:
            best, least = code, distance
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    reliability: np.ndarray

    def losses(self, features: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each codeword against the predicted bits."""
        margins = features @ self.weights + self.bias
        agree = margins[:, None, :] * self.code[None, :, :]
        return (np.logaddexp(0, -agree) * self.reliability).sum(axis=2)

    def decode(self, features: np.ndarray, min_margin: float = MIN_MARGIN):
        """Nearest language, its probability, and whether another one is about as near."""
        losses = self.losses(features)
        best = losses.argmin(axis=1)
        chance = np.exp(losses.min(axis=1, keepdims=True) - losses)
        score = 1 / chance.sum(axis=1)
        if losses.shape[1] > 1:
            two = np.partition(losses, 1, axis=1)
            close = two[:, 1] - two[:, 0] < min_margin * self.reliability.sum()
        else:
            close = np.zeros(len(losses), bool)
        return best, score, close


def fit_codes(features: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = SEED) -> LanguageModel:
    """Fit one logistic classifier per bit of the codewords, all bits at once, by mini-batches."""
    code = codewords(len(languages), seed)
    targets = code[labels].astype(np.float32)
    weights = np.zeros((features.shape[1], code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    squares, bias_squares = np.full_like(weights, 1e-6), np.full_like(bias, 1e-6)
    # Languages weigh the same, however many rows each has.
    share = 1 / np.bincount(labels, minlength=len(languages))[labels]
    share = (share / share.mean()).astype(np.float32)[:, None]
    rng = np.random.default_rng(seed)
    for _ in range(12):
        order = rng.permutation(len(features))
        for i in range(0, len(order), 64):
            rows = order[i : i + 64]
            x, t = features[rows], targets[rows]
            slope = -t / (1 + np.exp(np.clip(t * (x @ weights + bias), -30, 30))) * share[rows] / len(rows)
            step, bias_step = x.T @ slope + 1e-5 * weights, slope.sum(axis=0)
            squares += step * step
            bias_squares += bias_step * bias_step
            weights -= 0.5 * step / np.sqrt(squares)
            bias -= 0.1 * bias_step / np.sqrt(bias_squares)
    wrong = (np.sign(features @ weights + bias) != targets).mean(axis=0)
    return LanguageModel(languages, code, weights, bias, (1 - np.minimum(2 * wrong, 0.99)).astype(np.float32))


def fit_languages(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> LanguageModel:
    """Fit on a bounded sample of ``doc_id, text, lang`` rows, the same number for each language.

    Rows are chosen by a hash of their id, so the sample does not depend on their order; no more than
    ``sample_rows`` rows (and a tenth more) of features reach the driver, whatever the corpus holds.
    """
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    rows = rows.withColumn("draw", F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 64 - DRAW_BITS))
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel([], np.ones((0, 1), np.int8), np.zeros((sum(BUCKETS), 1), np.float32), np.zeros(1), np.ones(1))
    each = max(1, sample_rows // len(languages))
    limits = [(lang, int(min(1.0, each / totals[lang]) * ((1 << DRAW_BITS) - 1))) for lang in languages]
    limit = F.create_map(*[F.lit(x) for pair in limits for x in pair])[F.col("lang")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = gram_counts(*arrow_text(batch.column(0)))
            # Half precision: the sample is sent to the driver.
            rows = [as_features(c[None, :]).astype(np.float16).tobytes() for c in counts]
            columns = [batch.column(1), batch.column(2), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "draw", "features"])

    drawn = rows.where(F.col("draw") <= limit).select("text", "lang", "draw")
    drawn = in_batches(drawn, count, "lang string, draw long, features binary")
    found = drawn.orderBy("draw", "lang", "features").limit(sample_rows + sample_rows // 10).toArrow()
    features = np.stack([np.frombuffer(x.as_buffer(), np.float16) for x in found["features"]]).astype(np.float32)
    names = found["lang"].to_pylist()
    seen = sorted(set(names))
    return fit_codes(features, np.array([seen.index(x) for x in names]), seen, seed)


def judge(model: LanguageModel, column: pa.Array, min_margin: float = MIN_MARGIN) -> list[pa.Array]:
    """Language, score and ambiguity of each text of an Arrow column."""
    texts = column.to_pylist()
    lettered = [bool(model.languages) and t is not None and any(map(str.isalpha, t)) for t in texts]
    names, scores, close = [], [], []
    block: list[np.ndarray] = []
    for i, row in enumerate(gram_counts(*arrow_text(column)) if model.languages else ()):
        block.append(row)
        if len(block) == 128 or i + 1 == len(texts):
            best, chance, near = model.decode(as_features(np.stack(block)), min_margin)
            names += [model.languages[k] for k in best]
            scores += chance.tolist()
            close += near.tolist()
            block = []
    if not model.languages:
        names, scores, close = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    return [
        pa.array([n if ok else UNKNOWN for n, ok in zip(names, lettered)], pa.string()),
        pa.array([float(s) if ok else 0.0 for s, ok in zip(scores, lettered)], pa.float64()),
        pa.array([c or not ok for c, ok in zip(close, lettered)], pa.bool_()),
    ]


def keep_identified(docs: DataFrame, model: LanguageModel, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs``, with all columns, whose language is told and not ambiguous; no row is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ambiguous = judge(shared.value, batch.column("text"), min_margin)[2]
            yield batch.filter(pa.compute.invert(ambiguous))

    return in_batches(docs, keep, docs.schema)


def identify_languages(docs: DataFrame, model: LanguageModel, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row, from its whole text.

    ``lang_pred`` is a learned language, or ``und`` if the text is null or has no letter (then ``score`` is
    0). ``ambiguous`` marks texts whose two nearest codewords are about equally near; ``und`` is ambiguous too.

    Edge cases: repeated rows give repeated results; a model without languages answers ``und``; an empty table
    gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), *judge(shared.value, batch.column(1), min_margin)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_batches(rows, score, "doc_id long, lang_pred string, score double, ambiguous boolean")


def fold_of(doc_id: Column, folds: int) -> Column:
    """Fold of a document by the crc32 of its id as text; -1 without id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)), F.lit(-1))
