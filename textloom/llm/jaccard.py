"""Near duplicates by a grouped prefix join on word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import (
    BLANK_WORDS,
    arrow_text,
    components,
    gram_hashes,
    hash_words,
    id_filter,
    id_slot,
    in_batches,
    in_filter,
    mix,
    slabs,
)
from textloom.session import stored

WORDS, PERCENT = 5, 80
# Shingles that the shared order puts last, and the documents of one block that make one of them. A block
# holds consecutive documents with so many shingles. They change which shingles stand in a prefix, never
# which documents are linked.
FREQUENT, FREQUENT_IN_BLOCK, BLOCK_SHINGLES = 200_000, 3, 4_000_000
# Numbers of 64 bits that hold the parities of a set: one bit for each value of the low bits of its shingles.
PARITIES = [f"b{i}" for i in range(16)]
# Classes compared with one copy of a head's set.
MEMBERS = 256
# Requests for sets that are broadcast, so that sets are shuffled once; about 50 MB. More requests are shuffled.
REQUESTS = 1 << 20
# A bucket of more rows first meets about so many of its groups in each round, drawn by a hash of group and shingle.
LARGE, DRAWN = 8, (8, 64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    for a, b in slabs(offsets):
        hashes, _, _, before = hash_words(data, offsets[a : b + 1], BLANK_WORDS)
        grams = gram_hashes(hashes, words) if len(hashes) >= words else hashes[:0]
        for i in range(b - a):
            first, last = int(before[i]), int(before[i + 1])
            if last - first >= words:
                yield np.unique(grams[first : last - words + 1])
            elif last > first:
                yield gram_hashes(hashes[first:last], last - first)
            else:
                yield hashes[:0]


def prefix_length(n: int, percent: int) -> int:
    """Sets of ``n`` shingles that link share one of the first so many in any common order."""
    return n - -(-percent * n // 100) + 1 if n else 0


def frequent_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, with their counts; at most FREQUENT of them."""

    def often(block: list[np.ndarray]) -> pa.RecordBatch:
        flat, apart = np.concatenate(block), FREQUENT_IN_BLOCK - 1
        block.clear()
        flat.sort()
        # All but the first ``apart`` places of each run that is long enough.
        values, n = np.unique(flat[apart:][flat[apart:] == flat[:-apart]], return_counts=True)
        columns = [pa.array(values.view(np.int64)), pa.array(n.astype(np.int64) + apart)]
        return pa.RecordBatch.from_arrays(columns, names=["shingle", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        for batch in batches:
            for values in shingle_sets(*arrow_text(batch.column(0)), words):
                if len(values):
                    block.append(values)
                    held += len(values)
                if held >= BLOCK_SHINGLES:
                    yield often(block)
                    held = 0
        if block:
            yield often(block)

    counted = in_batches(docs.select("text"), count, "shingle long, n long")
    top = counted.groupBy("shingle").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT)
    found = top.toArrow()
    shingles, n = found["shingle"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], n[order]


def set_key(values: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    if not len(values):
        return 0, 0
    return int(values.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(values)).view(np.int64))


def parities(values: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles has each value of the low bits, packed."""
    size = 64 * len(PARITIES)
    odd = np.bincount((values & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_prefixes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n, s1, s2, p1, p2, rare, often`` and parities of each row: set size, set key, prefix key, prefix.

    ``often`` holds the shingles of the prefix that are among the most frequent ones of the corpus.
    """
    frequent, counts = frequent_shingles(docs, words)
    shared = docs.sparkSession.sparkContext.broadcast((frequent, counts))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = shared.value
        for batch in batches:
            n, keys, heads, tails, odd = [], [], [], [], []
            for values in shingle_sets(*arrow_text(batch.column("text")), words):
                n.append(len(values))
                odd.append(parities(values))
                keys.append(set_key(values))
                length = prefix_length(len(values), percent)
                often = values[:0]
                if len(frequent) and len(values):
                    at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                    weight = np.where(frequent[at] == values, counts[at], 0)
                    known = np.flatnonzero(weight)
                    often = values[known[np.argsort(weight[known], kind="stable")]]
                    values = values[weight == 0]
                heads.append(values[:length].view(np.int64))
                tails.append(often[: max(0, length - len(values))].view(np.int64))
            head_keys = [set_key(np.concatenate([h, t]).view(np.uint64)) for h, t in zip(heads, tails)]
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64())]
            columns += [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
            columns += [pa.array([k[i] for k in head_keys], pa.int64()) for i in (0, 1)]
            for lists in (heads, tails):
                sizes = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)))
            bits = np.array(odd, np.int64).reshape(-1, len(PARITIES))
            columns += [pa.array(bits[:, i]) for i in range(len(PARITIES))]
            names = ["doc_id", "text_hash", "n", "s1", "s2", "p1", "p2", "rare", "often", *PARITIES]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    schema = "doc_id long, text_hash long, n long, s1 long, s2 long, p1 long, p2 long, rare array<long>, often array<long>, "
    schema += ", ".join(f"{b} long" for b in PARITIES)
    return stored(in_batches(rows, prefixes, schema), "prefixes")


def verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``a, b`` of pairs whose whole shingle sets are similar enough, stored.

    ``pairs`` holds ``a, da, sa, b, db, sb``: two classes, and a document and the first set key of each. Sets are computed again
    from the texts of the documents asked for. The set of ``a`` is sent once for MEMBERS sets it is compared with, in a
    stream sorted so that it comes before them; a class of any number of partners is spread over many tasks. Up to REQUESTS
    requests are broadcast to the texts, so sets move once.
    """
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c"))
    parts = F.expr(f"cast(c div {MEMBERS} + 1 as int)")
    asked = pairs.join(counts, "a").withColumn("part", F.pmod(F.xxhash64("b"), parts).cast("int"))
    asked = stored(asked.select("a", "da", "sa", "b", "db", "sb", "part"), "asked")
    heads = asked.select("a", "part", F.lit(0).alias("role"), F.col("a").alias("b"), F.col("da").alias("doc_id"), F.col("sa").alias("s1"))
    members = asked.select("a", "part", F.lit(1).alias("role"), "b", F.col("db").alias("doc_id"), F.col("sb").alias("s1"))
    requests = heads.distinct().union(members)
    few = requests.limit(REQUESTS + 1).count() <= REQUESTS
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(requests, "doc_id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(bits, batch.column("slot").to_numpy())))
            keys, values = [], []
            for own in shingle_sets(*arrow_text(batch.column("text")), words):
                keys.append(set_key(own)[0])
                values.append(own.tobytes())
            columns = [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "s1", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    if few:
        rows = rows.join(F.broadcast(requests.select("doc_id").distinct()), "doc_id", "left_semi")
    rows = rows.withColumn("slot", id_slot(F.col("doc_id")))
    found = in_batches(rows, sets, "doc_id long, s1 long, shingles binary")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, of = np.zeros(0, np.uint64), None
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("a", "part", "role")))
            keep = []
            for (a, part, role), own in zip(places, batch.column("shingles")):
                y = np.frombuffer(own.as_buffer(), np.uint64)
                if role == 0:
                    head, of = y.copy(), (a, part)
                if role == 0 or of != (a, part):
                    keep.append(False)
                    continue
                x, y = (head, y) if len(head) <= len(y) else (y, head)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sent = found.join(F.broadcast(requests) if few else requests, ["doc_id", "s1"]).select("a", "part", "role", "b", "shingles")
    sent = sent.repartition("a", "part").sortWithinPartitions("a", "part", "role")
    return stored(in_batches(sent, similar, "a long, b long").distinct(), "links")


def linked(docs: DataFrame, pairs: DataFrame, comps: DataFrame | None, words: int, percent: int) -> DataFrame:
    """``id, component`` of classes: ``comps`` with the links among ``pairs``, which hold the columns of ``PAIR``.

    Each class is compared with the smallest partner it has, then pairs whose classes are still in different components
    are. A pair inside a component cannot join any, so large sets are seldom sent for more than a tree of links.
    """
    first = pairs.groupBy("b").agg(F.min(F.struct("a", "da", "sa", "db", "sb")).alias("least"))
    first = stored(first.select("least.a", "least.da", "least.sa", "b", "least.db", "least.sb"), "first")
    links = verified(docs, first, words, percent)
    comps = components(links if comps is None else links.union(as_edges(comps)))
    apart = pairs.join(first.select("a", "b"), ["a", "b"], "left_anti")
    for name in ("a", "b"):
        apart = apart.join(comps.select(F.col("id").alias(name), F.col("component").alias(f"c{name}")), name, "left")
    apart = apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
    apart = stored(apart.select(PAIR), "apart")
    if apart.isEmpty():
        return comps
    links = verified(docs, apart, words, percent)
    return comps if links.isEmpty() else components(links.union(as_edges(comps)))


def may_start(percent: int) -> F.Column:
    """Whether similar sets of ``x`` and ``y`` shingles can have their first common one at ``i`` and ``j``.

    What stands before it is in one set only, which bounds the intersection. Some shingle of each pair
    that links, its first common one, passes.
    """
    most = F.least(F.col("x") - F.col("i"), F.col("y") - F.col("j"))
    enough = most * (100 + percent) >= percent * (F.col("x") + F.col("y"))
    return enough & (100 * F.least("x", "y") >= percent * F.greatest("x", "y"))


def may_be_close(percent: int) -> F.Column:
    """Whether sets of ``x`` and ``y`` shingles with the parities ``a_b0...`` and ``b_b0...`` can be similar enough.

    Two parities differ only where a shingle of one set alone has those low bits, so their number is at most
    the number of shingles that the sets do not share.
    """
    unlike = sum((F.bit_count(F.col(f"a_{b}").bitwiseXOR(F.col(f"b_{b}"))) for b in PARITIES), F.lit(0))
    return unlike * (100 + percent) <= (100 - percent) * (F.col("x") + F.col("y"))


def side(frame: DataFrame, name: str, size: str) -> DataFrame:
    """Class columns of ``frame`` under the names of one side of a pair; other columns stay."""
    names = {"cid": name, "doc": f"d{name}", "s1": f"s{name}", "n": size} | {b: f"{name}_{b}" for b in PARITIES}
    return frame.withColumnsRenamed(names)


def as_edges(comps: DataFrame) -> DataFrame:
    return comps.select(F.col("id").alias("a"), F.col("component").alias("b"))


def largest_component(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``main`` of each bucket of several components: the component of most rows."""
    counts = rows.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("c"))
    largest = counts.groupBy(*keys).agg(F.max(F.struct("c", "component")).alias("top"), F.count(F.lit(1)).alias("several"))
    return largest.where("several > 1").select(*keys, F.col("top.component").alias("main"))


def drawn_pairs(rows: DataFrame, other: DataFrame, drawn: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` of ``other`` groups of a bucket with about ``drawn`` of its ``rows``, for other components.

    Both hold ``token, at, n, gid, c, component``. The number of pairs is linear in the rows.
    """
    own = rows.where(F.pmod(F.xxhash64("gid", "token"), F.greatest(F.lit(1), F.expr(f"c div {drawn}"))) == 0)
    own = own.select("token", F.col("gid").alias("a"), F.col("at").alias("i"), F.col("n").alias("x"), F.col("component").alias("ca"))
    other = other.select("token", F.col("gid").alias("b"), F.col("at").alias("j"), F.col("n").alias("y"), F.col("component").alias("cb"))
    pairs = own.join(other, "token").where((F.col("ca") != F.col("cb")) & may_start(percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


PAIR = ["a", "da", "sa", "b", "db", "sb"]


def class_components(own: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``s1, s2, n, doc, component`` of each class of equal sets; the method is described at ``near_duplicates``."""
    keys = own.where("n > 0 and doc_id is not null").drop("rare", "often")
    # Prefix and parities are a function of the set, so any row of a class has them.
    classes = keys.groupBy("s1", "s2", "n").agg(
        F.min("doc_id").alias("doc"), *(F.min(c).alias(c) for c in ("p1", "p2", *PARITIES))
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    groups = classes.groupBy("n", "p1", "p2").agg(F.min("cid").alias("gid"))
    member = stored(classes.drop(*PARITIES).join(groups, ["n", "p1", "p2"]).drop("p1", "p2"), "members")

    heads = member.where("cid = gid").select("gid", F.col("doc").alias("doc_id"), "s1", "s2", "n")
    prefixes = own.select("doc_id", "s1", "s2", "n", "rare", "often").join(heads, ["doc_id", "s1", "s2", "n"])
    rare = prefixes.select("gid", "n", F.posexplode("rare").alias("at", "token"))
    often = prefixes.where(F.size("often") > 0).select("gid", "n", F.size("rare").alias("before"), F.posexplode("often").alias("at", "token"))
    often = often.withColumn("at", F.col("at") + F.col("before")).drop("before")

    # One shuffle of the shingles; a bucket that passes memory is spilled by the window.
    bucket = Window.partitionBy("token")

    def open_buckets(rows: DataFrame) -> DataFrame:
        ends = {"low": F.min("gid").over(bucket), "high": F.max("gid").over(bucket), "c": F.count(F.lit(1)).over(bucket)}
        return rows.withColumns(ends).where("low <> high").select("token", "gid", "at", "n", "c")

    buckets = stored(open_buckets(rare).union(open_buckets(often)), "buckets")

    plain = classes.select("cid", "doc", "s1", "n", *PARITIES)

    def close(pairs: DataFrame) -> DataFrame:
        """``PAIR`` of those ``a, b`` whose parities are close."""
        both = pairs.join(side(plain, "a", "x"), "a").join(side(plain, "b", "y"), "b")
        return both.where(may_be_close(percent)).select(PAIR)

    large = buckets.where(F.col("c") > LARGE)
    inside = member.where("cid <> gid").select(F.col("gid").alias("a"), F.col("cid").alias("b"))
    rows = large.withColumn("component", F.col("gid"))
    star = drawn_pairs(rows, rows, DRAWN[0], percent)
    tried = stored(close(star.union(inside).distinct()), "tried")
    comps = linked(docs, tried, None, words, percent)
    for drawn in DRAWN[1:]:
        rows = large.join(comps.withColumnRenamed("id", "gid"), "gid", "left")
        rows = stored(rows.withColumn("component", F.coalesce("component", "gid")), "large")
        outside = rows.join(largest_component(rows, ["token"]), "token").where("component <> main")
        star = drawn_pairs(rows, outside, drawn, percent).distinct()
        star = stored(close(star.join(tried.select("a", "b"), ["a", "b"], "left_anti")), "tried")
        tried = tried.union(star)
        if star.isEmpty():
            break
        comps = linked(docs, star, comps, words, percent)
    placed = member.select("gid", "cid", "n").join(comps.withColumnRenamed("id", "cid"), "cid", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "cid")), "placed")

    of_token = buckets.select("token", "at", "gid", "n").join(placed.drop("n"), "gid").withColumn("grouped", F.lit(False))
    of_group = placed.withColumn("token", F.col("gid")).withColumn("grouped", F.lit(True)).withColumn("at", F.lit(0))
    columns = ["token", "grouped", "at", "n", "cid", "component"]
    rows = of_token.select(columns).union(of_group.select(columns))
    several = largest_component(rows, ["token", "grouped"])
    open_rows = stored(rows.join(several, ["token", "grouped"]), "open")
    out = open_rows.where("component <> main").drop("main")
    out = out.withColumnsRenamed({"cid": "a", "at": "i", "n": "x", "component": "ca"})
    every = open_rows.withColumnsRenamed({"cid": "b", "at": "j", "n": "y", "component": "cb"})
    # Of two classes outside the largest component the pair is met from the smaller one only.
    once = (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("a") < F.col("b")))
    rest = out.join(every, ["token", "grouped"]).where(once & may_start(percent))
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = close(rest.join(tried.select("a", "b"), ["a", "b"], "left_anti"))
    rest = stored(rest, "rest")
    if not rest.isEmpty():
        comps = linked(docs, rest, comps, words, percent)
    joined = member.join(comps.withColumnRenamed("id", "cid"), "cid", "left")
    return joined.select("s1", "s2", "n", "doc", F.coalesce("component", "cid").alias("component"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Words stand between blanks (ASCII), A-Z in lower case. A document's set holds its distinct runs of
    ``words`` words; one with fewer words has its whole sequence. Two documents link if their
    intersection holds at least ``percent`` hundredths of their union. ``component_id`` is the smallest
    ``doc_id`` reachable by links.

    Method: documents of equal sets are one class, classes of equal size and equal prefix one group.
    Prefixes follow one order of all shingles, rare ones first, so that linked sets share a shingle of
    their prefixes. First, in rounds, every group of a large bucket is compared with a few groups drawn
    from the bucket, others for each shingle, and every class with its group's; later rounds draw more, for
    groups outside the bucket's largest component only. That is linear however large a bucket is. Links
    make components. Then, in buckets that still hold several components,
    the classes outside the bucket's largest component are paired with the classes of other components,
    and pairs that can have their first common shingle there are compared. Of all pairs at hand, each class first
    meets its smallest partner only. Pairs inside a component need
    no comparison, so no link that joins components is lost. Before whole sets move, parities of their
    shingles rule out pairs that cannot link; they meet pairs, and are not copied to each shingle.
    Whole sets are compared, shingles by 64-bit hash of words that are hashed modulo a prime.

    Edge cases: a null, empty or blank text has no shingles, ``n_shingles`` 0 and its own ``doc_id``;
    repeated rows give repeated results; rows of one ``doc_id`` with different texts are
    documents of their own; rows without ``doc_id`` are left out of the links and keep a null
    component unless a document of the same set names one; an empty table gives no rows; other columns
    are ignored.
    """
    own = set_prefixes(docs, words, percent)
    classes = class_components(own, docs, words, percent)
    named = classes.groupBy("component").agg(F.min("doc").alias("component_id"))
    final = classes.join(named, "component").select("s1", "s2", "n", "component_id")
    return own.join(final, ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near copies, with all its columns: that of the smallest ``doc_id``, then set key.

    Documents of one ``doc_id`` and different texts are told apart by their texts. Documents without shingles or without
    ``doc_id`` are in no group and stay; rows that agree in ``doc_id`` and text stay together.
    """
    own = set_prefixes(docs, words, percent)
    classes = class_components(own, docs, words, percent)
    first = classes.groupBy("component").agg(F.min(F.struct("doc", "s1", "s2", "n")).alias("first")).select("first.*")
    kept = own.join(first, ["s1", "s2", "n"]).where(F.col("doc_id") == F.col("doc"))
    kept = kept.select("doc_id", "text_hash")
    kept = kept.union(own.where("n = 0 and doc_id is not null").select("doc_id", "text_hash")).toDF("_kept_id", "_kept_text")
    same = (docs["doc_id"] == kept["_kept_id"]) & (F.xxhash64(docs["text"]) == kept["_kept_text"])
    return docs.join(kept, same, "left_semi").unionByName(docs.where("doc_id is null"))
