"""Phrase collocations of each language by best-first branch and bound over word prefixes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import arrow_text, byte_table, gram_hashes, hash_words, in_batches, in_filter, mix, slabs
from textloom.session import stored

LEAST, LONGEST, TOP = 100, 5, 2000
UNKNOWN = "und"
# Occurrences of first words that one round expands. A round holds about BATCH / LEAST first words at most, and
# so many prefixes of each length, which bounds what is broadcast.
BATCH = 1 << 24
# Bits of a filter over phrases: 8 for each phrase and at least 2^16. A round of BATCH stays far below the most.
LEAST_BITS, MOST_BITS = 16, 27
# So many languages are named in a filter of rows; more are told apart by the phrases alone.
LISTED = 500

CUTS = b".,;:!?" + bytes(range(0x0A, 0x0E))
WORDS = byte_table(b" \t" + CUTS)
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
IS_CUT = np.zeros(256, bool)
IS_CUT[list(CUTS)] = True
# Bytes of a gap between words that are looked at one by one.
GAP = 8


def language_keys(column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language of each row and a hash of it."""
    names = [UNKNOWN if x is None else x for x in column.to_pylist()]
    known = {x: xxhash.xxh64_intdigest(x) for x in set(names)}
    return names, np.array([known[x] for x in names], np.uint64)


def cut_between(raw: np.ndarray, last: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a cut stands in each gap from ``last`` to before ``first``.

    Nearly all gaps end or are settled within two bytes, so only bytes of gaps are read.
    """
    found = (last < first) & IS_CUT[raw[last]]
    rest = np.flatnonzero((first - last > 1) & ~found)
    for step in range(1, GAP):
        if not len(rest):
            return found
        cut = IS_CUT[raw[last[rest] + step]]
        found[rest[cut]] = True
        rest = rest[~cut & (first[rest] - last[rest] > step + 1)]
    if len(rest):
        cuts = np.flatnonzero(IS_CUT[raw])
        found[rest] = np.searchsorted(cuts, last[rest]) < np.searchsorted(cuts, first[rest])
    return found


class Slab:
    """Words of consecutive texts: hashes, places, and the piece and text each stands in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray):
        self.hashes, self.first, self.last, before = hash_words(data, offsets, WORDS)
        self.raw = data[offsets[0] : offsets[-1]]
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        self.keys = keys[self.text]
        self.piece = np.zeros(len(self.hashes), np.int64)
        if len(self.hashes):
            apart = cut_between(self.raw, self.last[:-1], self.first[1:]) | (self.text[1:] != self.text[:-1])
            np.cumsum(apart, out=self.piece[1:])

    def windows(self, size: int) -> np.ndarray:
        """Words that start ``size`` words of one piece."""
        n = len(self.hashes) - size + 1
        return np.flatnonzero(self.piece[size - 1 :] == self.piece[:n]) if n > 0 else np.zeros(0, np.int64)

    def phrase_keys(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of language and words of each window."""
        return mix(gram_hashes(self.hashes, size)[at] ^ self.keys[at]) if len(at) else np.zeros(0, np.uint64)

    def strings(self, at: np.ndarray) -> pa.Array:
        """The words at some places, A-Z in lower case."""
        size = self.last[at] - self.first[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(self.first[at] - ends[:-1], size) + np.arange(ends[-1])
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(FOLDED[self.raw[index]])]
        return pa.Array.from_buffers(pa.large_string(), len(at), buffers)

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        import pyarrow.compute as pc

        words = [self.strings(at + i) for i in range(size)]
        return words[0] if size == 1 else pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()))


def equal_side(slab: Slab, at: np.ndarray, order: np.ndarray, starts: np.ndarray, step: int) -> pa.Array:
    """Per group of windows the word ``step`` words on, where all of them have the same one in their piece; else null."""
    beside = at + step
    edge = np.clip(beside, 0, len(slab.hashes) - 1)
    inside = (beside == edge) & (slab.piece[edge] == slab.piece[at])
    values = np.where(inside, slab.hashes[edge] | np.uint64(1), np.uint64(0))[order]
    low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
    same = (low == high) & (low != 0)
    words = slab.strings(edge[order[starts]])
    return words.take(pa.array(np.arange(len(starts)), pa.int64(), mask=~same))


COUNTED, SIDES = "lang string, size int, phrase string, n long", ", left string, right string"


def count_windows(
    docs: DataFrame, sizes: Sequence[int], admitted: np.ndarray | None = None, prefix: int = 0, sides: bool = False
) -> DataFrame:
    """``lang, size, phrase, n``, with ``sides`` also ``left, right``: windows of some sizes, combined inside slabs of text.

    Only windows whose first ``prefix`` words, or with 0 all of whose words, are in the filter ``admitted`` are
    counted. ``left`` and ``right`` name the neighbouring word where all windows of a row have the same.
    """
    schema = COUNTED + SIDES if sides else COUNTED
    shared = None if admitted is None else docs.sparkSession.sparkContext.broadcast(admitted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            langs, keys = language_keys(batch.column(0))
            lang_array = np.array(langs, object)
            data, offsets = arrow_text(batch.column(1))
            for a, b in slabs(offsets):
                slab = Slab(data, offsets[a : b + 1], keys[a:b])
                if not len(slab.hashes):
                    continue
                for size in sizes:
                    at = slab.windows(size)
                    if shared is not None:
                        at = at[admits(shared.value, slab.phrase_keys(at, prefix or size))]
                    if not len(at):
                        continue
                    keys_at = slab.phrase_keys(at, size)
                    # Windows of one key are alike, so their order does not matter.
                    order = np.argsort(keys_at)
                    ordered = keys_at[order]
                    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
                    n = np.diff(np.append(starts, len(ordered)))
                    one = at[order[starts]]
                    columns = [
                        pa.array(lang_array[a + slab.text[one]], pa.string()),
                        pa.array(np.full(len(one), size, np.int32)),
                        slab.phrases(one, size).cast(pa.string()),
                        pa.array(n.astype(np.int64)),
                    ]
                    if sides:
                        columns += [equal_side(slab, at, order, starts, step).cast(pa.string()) for step in (-1, size)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_batches(docs.select("lang", "text"), count, schema)


def admits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return in_filter(bits, (keys & np.uint64(32 * len(bits) - 1)).astype(np.int64))


def phrase_filter(phrases: DataFrame) -> np.ndarray:
    """Bit set over the hashes of ``lang, phrase`` rows, sized by their number.

    It spares windows that cannot be wanted. Phrases are counted by their words, so a bit too many costs
    rows and changes nothing.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (8 * phrases.count()).bit_length()))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, keys = language_keys(batch.column(0))
            data, offsets = arrow_text(batch.column(1))
            for a, b in slabs(offsets):
                slab = Slab(data, offsets[a : b + 1], keys[a:b])
                sizes = np.bincount(slab.text, minlength=b - a)
                first = np.cumsum(sizes) - sizes
                for size in np.unique(sizes).tolist():
                    found = slab.phrase_keys(first[sizes == size], size) & np.uint64((1 << bits) - 1)
                    words, bit = (found >> np.uint64(5)).astype(np.int64), (found & np.uint64(31)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bit)], names=["word", "bit"])

    rows = in_batches(phrases.select("lang", "phrase"), slots, "word long, bit int")
    found = rows.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out


def summed(rows: DataFrame) -> DataFrame:
    """``lang, size, phrase, f, dominated``: counts of phrases, and whether one word always stands on one side."""

    def constant(side: str) -> Column:
        always = F.count(side) == F.count(F.lit(1))
        return F.coalesce(always & (F.min(side) == F.max(side)), F.lit(False))

    return rows.groupBy("lang", "size", "phrase").agg(
        F.sum("n").alias("f"), (constant("left") | constant("right")).alias("dominated")
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of every word, stored."""
    rows = count_windows(docs, [1]).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    return stored(rows, "words")


def bound(n: str, first: str) -> Column:
    """No phrase that starts with a word of ``first`` occurrences scores more.

    Cut behind that word, a phrase scores 1000 a n / (l r) with l its first word and r, which holds the phrase, at
    least a.
    """
    return F.expr(f"cast({n} as decimal(19,0)) * 1000 div {first}")


def planned_rounds(frequent: DataFrame, batch: int) -> tuple[DataFrame, int]:
    """``lang, phrase, f, round`` of first words, stored, and the number of rounds.

    The rarest words, whose bound is highest, come first. Words of nearly equal frequency are one bucket;
    a bucket that is too large for one round is split by a hash of its words.
    """
    high = F.length(F.bin("f")) - 1
    bucket = high * 8 + F.expr("cast(shiftright(f, greatest(length(bin(f)) - 4, 0)) & 7 as int)")
    placed = frequent.withColumn("bucket", bucket)
    sizes = placed.groupBy("lang", "bucket").agg(F.sum("f").alias("occ"))
    whole = sizes.agg(F.sum("occ")).first()[0] or 0
    rounds = max(1, -(-whole // batch))
    # A few hundred buckets for each language at most.
    own = Window.partitionBy("lang")
    upto = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    shares = sizes.select("lang", "bucket", "occ", F.sum("occ").over(upto).alias("upto"), F.sum("occ").over(own).alias("total"))
    shares = shares.select(
        "lang",
        "bucket",
        F.expr(f"(upto - occ) * {rounds}D / total").cast("int").alias("head"),
        F.expr(f"(upto - 1) * {rounds}D / total").cast("int").alias("tail"),
    )
    spread = F.pmod(F.xxhash64("phrase"), F.col("tail") - F.col("head") + 1)
    return (
        stored(
            placed.join(shares, ["lang", "bucket"]).select("lang", "phrase", "f", (F.col("head") + spread).cast("int").alias("round")),
            "first-words",
        ),
        rounds,
    )


def grown(docs: DataFrame, words: DataFrame, least: int, longest: int) -> DataFrame | None:
    """``lang, size, phrase, f`` of the frequent phrases that start with given words, prefix by prefix."""
    found, prefixes, size = None, words.select("lang", "phrase"), 1
    # Beyond three words few prefixes are left, and two lengths are counted in one scan.
    while size < longest and not prefixes.isEmpty():
        sizes = [size + 1] if size < 3 else list(range(size + 1, longest + 1))
        rows = count_windows(docs, sizes, phrase_filter(prefixes), prefix=size)
        counted = rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
        # The filter may pass another prefix; its phrases belong to another round.
        start = F.array_join(F.slice(F.split("phrase", " "), 1, size), " ")
        exact = prefixes.select("lang", F.col("phrase").alias("start"))
        counted = counted.withColumn("start", start).join(exact, ["lang", "start"], "left_semi").drop("start")
        counted = stored(counted, "grown")
        found = counted if found is None else found.union(counted)
        prefixes, size = counted.select("lang", "phrase"), sizes[-1]
    return found


def scored(docs: DataFrame, candidates: DataFrame, frequent: DataFrame, totals: DataFrame, longest: int) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the candidates no longer phrase dominates."""
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w")).select(
        "lang", "phrase", "size", "a", "w", F.explode(F.expr("sequence(1, size - 1)")).alias("k")
    )
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.expr("slice(w, 1, k)"), " ").alias("left_part"),
        F.array_join(F.expr("slice(w, k + 1, size)"), " ").alias("right_part"),
    )
    parts = cuts.select("lang", F.col("right_part").alias("phrase")).where(F.contains("phrase", F.lit(" ")))
    needed = stored(candidates.select("lang", "phrase").union(parts).distinct(), "needed")
    rows = summed(count_windows(docs, list(range(2, longest + 1)), phrase_filter(needed), sides=True))
    counts = stored(rows.join(needed, ["lang", "phrase"], "left_semi"), "counts")
    known = counts.select("lang", "phrase", "f").union(frequent.select("lang", "phrase", "f"))
    open_ones = counts.where((F.col("size") < longest) & F.col("dominated")).select("lang", "phrase")
    left = known.select("lang", F.col("phrase").alias("left_part"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right_part"), F.col("f").alias("r"))
    valued = cuts.join(open_ones, ["lang", "phrase"], "left_anti").join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"])
    valued = valued.join(totals, "lang").withColumn(
        "score", F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    )
    lowest = valued.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, batch: int = BATCH
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` best phrases of each language.

    Words stand between blanks and tabs inside pieces, which end at ``.,;:!?`` and line ends; A-Z in lower case. A
    phrase of 2 to ``longest`` words that stands at least ``least`` times is a candidate. Its score is the
    lowest of floor(1000 a n / (l r)) over its cuts in two parts; it is dropped if a candidate that holds it
    stands as often. Order: score and ``a`` descending, phrase ascending.

    Method: first words wait by their bound, floor(1000 n / l), the rarest first. A round takes the best of them
    and lets their phrases grow word by word while the prefix is frequent; another scan counts the parts of
    these candidates and whether one word always stands beside them, which is what dominance by a longer
    candidate comes to. A language is settled once its ``top``-th score passes the bound of every word that
    waits; equal bounds are still expanded, so ties are whole. All scans read every document of the
    languages that are open, and counts are kept by the words themselves.

    Edge cases: a null language is ``und``; a null or empty text has no words; repeated rows count again; a language
    with fewer candidates returns all of them; an empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    words = word_counts(docs)
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent, rounds = planned_rounds(words.where(F.col("f") >= least), batch)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best: DataFrame | None = None
    waiting = frequent
    for i in range(rounds):
        # Per language: the best that is still to come against the last phrase of the list so far.
        still = waiting.groupBy("lang").agg(F.min("f").alias("first")).join(totals, "lang")
        still = still.withColumn("most", bound("n", "first"))
        if best is not None:
            reached = best.where(F.col("rank") == top).select("lang", "score")
            still = still.join(reached, "lang", "left").where(F.col("score").isNull() | (F.col("score") <= F.col("most")))
        still = stored(still.select("lang"), "open")
        names = [r["lang"] for r in still.limit(LISTED + 1).collect()]
        if not names:
            break
        text = docs.where(F.col("lang").isin(names)) if len(names) <= LISTED else docs
        now = waiting.where(F.col("round") == i).join(still, "lang", "left_semi")
        waiting = frequent.where(F.col("round") > i).join(still, "lang", "left_semi")
        candidates = grown(text, now, least, longest)
        if candidates is None:
            continue
        new = scored(text, candidates, frequent, totals, longest)
        every = new if best is None else best.drop("rank").union(new)
        best = stored(every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "best")
    if best is None:
        schema = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
        return docs.sparkSession.createDataFrame([], schema)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
