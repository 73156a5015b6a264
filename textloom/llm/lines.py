"""Near-duplicate lines by a deletion-neighbourhood join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import stored

# Shorter lines are only equal to equal lines.
MIN_CHARS = 16
# A line is cut into segments of this length, or more for long lines: at most so many segments.
SEGMENT, SEGMENTS = 16, 64
# Size of the table that spares documents without lines to look at.
SLOT_BITS = 18
# Half lines are cut at multiples of this.
GRID = 8
# A document, and the place of a line; earlier places are smaller.
DOC = ["doc_id", "text_key"]
PLACE = [*DOC, "line_no"]


def text_key() -> Column:
    """Hash of a text; rows that share a ``doc_id`` but not the text are told apart by it."""
    return F.xxhash64("text").alias("text_key")


def document_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, line_no, line`` without blank lines; white space at the ends is not part of a line."""
    pieces = F.posexplode(F.split(F.col("text"), "\n"))
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", text_key(), pieces.alias("line_no", "line"))
    return rows.withColumn("line", F.btrim("line", F.lit(" \t\r"))).where(F.col("line") != "")


def line_key(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("k1"), F.xxhash64(line, F.lit(1)).alias("k2")]


def half_keys(line: Column, min_chars: int = MIN_CHARS) -> Column:
    """Hashes of the halves that two lines one edit apart share.

    The edit lies outside the first or outside the last ``m`` characters, where ``m`` is half the shorter
    line's length, cut to the grid. A line serves as the shorter and as the longer one of a pair.
    """
    n = F.char_length(line)
    shorter = (n, F.greatest(n - 1, F.lit(min_chars)))
    sizes = F.array_distinct(
        F.array(*[F.floor(size / F.lit(2 * GRID)).cast("int") * GRID for size in shorter])
    )
    return F.flatten(
        F.transform(
            sizes,
            lambda m: F.array(
                F.xxhash64(F.lit("head"), m, F.substring(line, F.lit(1), m)),
                F.xxhash64(F.lit("tail"), m, F.substring(line, n - m + 1, m)),
            ),
        )
    )


def segments(line: Column, longer: bool, size: Column | None = None) -> Column:
    """``grown, around, hole``: the line without each of its segments, hashed, and the segment.

    Two lines one edit apart agree outside one segment. Segments are those of the shorter line of a pair
    of ``n`` characters, counted from the start in front of the segment and from the end behind it; a
    line is taken as the shorter one, and with ``longer`` as the one that has a character more. ``size`` is the
    column of its length; without one it is counted again wherever a segment needs it.
    """
    size = F.char_length(line) if size is None else size
    n = size - 1 if longer else size
    step = F.greatest(F.lit(SEGMENT), F.floor(n / F.lit(SEGMENTS)).cast("int"))

    def segment(j: Column) -> Column:
        start = j * step
        tail = F.greatest(n - start - step, F.lit(0))
        before, after = F.substring(line, F.lit(1), start), F.substring(line, size - tail + 1, tail)
        return F.struct(
            F.lit(longer).alias("grown"),
            F.xxhash64(n, j, F.xxhash64(before), F.xxhash64(after)).alias("around"),
            F.substring(line, start + 1, size - tail - start).alias("hole"),
        )

    return F.transform(F.sequence(F.lit(0), F.floor(n / step).cast("int")), segment)


def variants(around: Column, hole: Column, grown: Column) -> Column:
    """``key, kind`` of a segment in its surroundings and of all its variants with one character deleted.

    Lines of equal length meet without the same character (``same``); a line meets a longer one as it is
    (``line``) where that has lost a character (``cut``).
    """
    size = F.char_length(hole)
    places = F.filter(F.sequence(F.lit(0), size), lambda i: i > 0)

    def without(i: Column) -> Column:
        return F.concat(F.substring(hole, F.lit(1), i - 1), F.substring(hole, i + 1, size))

    def entry(kind: str, *parts: Column) -> Column:
        return F.struct(F.xxhash64(around, *parts).alias("key"), F.lit(kind).alias("kind"))

    cuts = F.transform(places, lambda i: entry("cut", without(i)))
    same = F.transform(places, lambda i: entry("same", without(i), i))
    return F.when(grown, cuts).otherwise(F.concat(F.array(entry("line", hole)), same))


def maybe_among(ids: DataFrame, column: str) -> Column:
    """Whether a row's id may be among ``ids``: false only where it is not.

    A table of 2^SLOT_BITS bytes marks the hashes of all ids. Its size is fixed; with very many ids it spares
    fewer rows, and the join behind it decides.
    """
    slot = F.xxhash64(column).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int")
    marks = bytearray(1 << SLOT_BITS)
    for (place,) in ids.select(slot).distinct().collect():
        marks[place] = 1
    return F.substring(F.lit(bytes(marks)), slot + 1, F.lit(1)) == F.lit(b"\x01")


def near_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``k1, k2``: lines that have an earlier line one edit away, and that line's first place.

    A first pass keeps hashes of half lines; only lines that share a half with another line are read
    again. Of these, the segments are kept outside which another line is the same, and all variants
    of such a segment within one deletion are emitted as keys. Equal variants meet: variants that lack
    the same position are one substitution apart, a variant equal to a line as it is, one insertion.
    Each key passes on its earliest member, so a key with many lines costs its lines, not their
    pairs, and still gives each of them its earliest neighbour. That neighbour's text is verified by
    edit distance.
    """
    long_lines = document_lines(docs).where(F.char_length("line") >= min_chars)
    keyed = long_lines.select(*PLACE, *line_key(F.col("line")), half_keys(F.col("line"), min_chars).alias("halves"))
    # One row per distinct line; its halves depend on the line alone.
    firsts = keyed.groupBy("k1", "k2", "halves").agg(F.min(F.struct(*PLACE)).alias("place"))
    firsts = stored(firsts, "lines-distinct")
    firsts = firsts.select("k1", "k2", "place.*", F.explode("halves").alias("half"))
    shared = firsts.groupBy("half").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low <> high")
    chosen = firsts.join(shared.select("half"), "half", "left_semi").select("k1", "k2", *PLACE).distinct()
    chosen = stored(chosen, "lines-chosen")

    of_doc = chosen.groupBy(*DOC).agg(F.collect_set("line_no").alias("wanted"))
    held = docs.select("doc_id", text_key(), "text").where(maybe_among(chosen, "doc_id")).join(of_doc, DOC)
    held = held.select(*DOC, F.split("text", "\n").alias("pieces"), "wanted")
    wanted = F.transform(
        "wanted", lambda i: F.struct(i.alias("line_no"), F.try_element_at("pieces", i + 1).alias("line"))
    )
    texts = held.select(*DOC, F.explode(wanted).alias("x"))
    texts = texts.select(*DOC, "x.line_no", F.btrim("x.line", F.lit(" \t\r")).alias("line"))
    texts = stored(texts.select(*PLACE, "line", *line_key(F.col("line"))), "lines-texts")

    line, size = F.col("line"), F.col("size")
    own = segments(line, False, size)
    both = F.when(size > min_chars, F.concat(own, segments(line, True, size))).otherwise(own)
    around = texts.withColumn("size", F.char_length("line")).select(
        F.struct(*PLACE).alias("place"), "k1", "k2", F.explode(both).alias("s")
    )
    around = stored(around.select("place", "k1", "k2", "s.grown", "s.around", "s.hole"), "lines-segments")
    met = around.groupBy("around").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low <> high")
    live = around.join(met.select("around"), "around", "left_semi")
    emitted = variants(F.col("around"), F.col("hole"), F.col("grown"))
    own = live.select("place", "k1", "k2", F.explode(emitted).alias("v")).select("place", "k1", "k2", "v.key", "v.kind")
    own = stored(own, "lines-variants")

    def first(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.col("place"))).alias(f"first_{kind}")

    firsts = own.groupBy("key").agg(first("same"), first("line"), first("cut"))
    met = own.join(firsts, "key")
    other = (
        F.when(F.col("kind") == "same", F.col("first_same"))
        .when(F.col("kind") == "line", F.col("first_cut"))
        .otherwise(F.col("first_line"))
    )
    earlier = met.groupBy("k1", "k2", "place").agg(F.min(F.when(other < F.col("place"), other)).alias("other"))
    earlier = earlier.where(F.col("other").isNotNull())
    left = texts.select("k1", "k2", "line")
    right = texts.select(F.struct(*PLACE).alias("other"), F.col("line").alias("other_line"))
    checked = earlier.join(left, ["k1", "k2"]).join(right, "other")
    return checked.where(F.levenshtein("line", "other_line", 1) == 1).select(
        "k1", "k2", F.col("other.doc_id").alias("near_doc"), F.col("other.line_no").alias("near_line")
    ).dropDuplicates(["k1", "k2"])


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_key, line_no, near``: lines that go, either equal (``near`` false) or close to an earlier one."""
    places = document_lines(docs).select(*PLACE, *line_key(F.col("line")))
    first = F.min(F.struct(*PLACE)).alias("first")
    repeated = places.groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    again = places.join(repeated.select("k1", "k2", "first"), ["k1", "k2"])
    again = again.where(F.struct(*PLACE) != F.col("first"))
    close = places.join(near_lines(docs, min_chars).select("k1", "k2"), ["k1", "k2"])
    return again.select(*PLACE, F.lit(False).alias("near")).union(close.select(*PLACE, F.lit(True).alias("near")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, n_near, text`` of every document, ``text`` without the lines that go.

    Lines are the pieces between line ends without blanks at their ends; blank lines stay and are not
    counted. A line goes if an equal line stands earlier (by ``doc_id``, then line number), or if an earlier
    line is one character insertion, deletion or substitution away, both of at least ``min_chars``
    characters. ``n_dropped`` counts the lines that go, ``n_near`` those that go as close to an earlier one.

    Edge cases: a null text stays null with no lines; an empty text has none; rows that agree in
    ``doc_id`` and text are one document: the same lines of both stay; rows of one ``doc_id`` with different
    texts are several, ordered by a hash of the text before the line number; rows without ``doc_id`` come
    before all others; an empty table gives no rows; other columns are ignored.
    """
    no_id = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("doc_id"), "text")
    gone = dropped_lines(rows, min_chars).groupBy(*DOC).agg(
        F.collect_set("line_no").alias("gone"), F.collect_set(F.when(F.col("near"), F.col("line_no"))).alias("close")
    )
    pieces = F.split("text", "\n")
    joined = rows.select("doc_id", text_key(), "text").join(gone, DOC, "left").select(
        F.when(F.col("doc_id") != no_id, F.col("doc_id")).alias("doc_id"),
        "text",
        pieces.alias("pieces"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
        F.coalesce("close", F.array().cast("array<int>")).alias("close"),
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("pieces") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.element_at("pieces", i + 1)), "\n")
    filled = F.filter("pieces", lambda x: F.btrim(x, F.lit(" \t\r")) != "")
    return joined.select(
        "doc_id",
        F.coalesce(F.size(filled), F.lit(0)).alias("n_lines"),
        F.size("gone").alias("n_dropped"),
        F.size("close").alias("n_near"),
        F.when(F.col("text").isNotNull(), kept).alias("text"),
    )
