"""Parts of speech in context: counts fitted on Spark, the cheapest tag sequence of each sentence."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.annotations import TOKEN
from textloom.operators.annotate import UNKNOWN_TAGS
from textloom.operators.joins import lookup_join
from textloom.session import stored

# Costs are thousandths of a natural logarithm, rounded down, so that sums are exact.
SCALE = 1000
# Cost of a tag that a word cannot have.
NEVER = 10**8
# Tags whose shapes are certain for words that were not learned.
CERTAIN_TAGS = ("SYM", "CD")
# A tag set is a fixed inventory; more distinct tags mean that the column holds something else.
MAX_TAGS = 1000


@dataclass
class TagModel:
    """``lexicon`` is ``word, costs`` with a cost per tag of ``tags``; the rest grows with the tags alone."""

    tags: list[str]
    learned: list[str]
    lexicon: DataFrame
    start: np.ndarray
    follow: np.ndarray
    unknown: list[int]


def _cost(whole: Column, part: Column) -> Column:
    return F.floor(F.lit(SCALE) * F.log(whole / part)).cast("int")


def fit_tag_model(tagged: DataFrame) -> TagModel:
    """Fit on ``words array<string>, tags array<string>``, a row per sentence with as many tags as words.

    With add-one counts over the lower-cased words, a tag costs ``ln((n(tag) + words) / (n(word, tag) + 1))``, to follow
    another ``ln((n(other followed) + tags) / (n(other, tag) + 1))``, and to begin a sentence likewise. Pairs
    without a word or a tag are left out. Only counts of tags and of pairs of tags reach the driver.
    """
    pairs = F.filter(
        F.arrays_zip(F.col("words").alias("word"), F.col("tags").alias("pos")),
        lambda x: x["word"].isNotNull() & x["pos"].isNotNull(),
    )
    sentences = stored(tagged.select(pairs.alias("p")).where(F.size("p") > 0), "tagged")
    counts = stored(
        sentences.select(F.explode("p").alias("p"))
        .groupBy(F.lower("p.word").alias("word"), F.col("p.pos").alias("pos"))
        .agg(F.count(F.lit(1)).alias("n")),
        "tag-counts",
    )
    totals = counts.groupBy("pos").agg(F.sum("n").alias("n")).orderBy("pos").limit(MAX_TAGS + 1).collect()
    if not totals or len(totals) > MAX_TAGS:
        raise ValueError(f"a tagged corpus has 1 to {MAX_TAGS} tags")
    of_tag = {r["pos"]: r["n"] for r in totals}
    tags = sorted({*of_tag, *CERTAIN_TAGS})
    words = counts.select("word").distinct().count()

    # A null before the first tag stands for the start of the sentence.
    chain = F.concat(F.array(F.lit(None).cast("string")), F.col("p.pos"))
    steps = sentences.select(F.explode(F.arrays_zip(chain.alias("before"), F.col("p.pos").alias("pos"))).alias("s"))
    steps = steps.where("s.pos IS NOT NULL").groupBy("s.before", "s.pos").agg(F.count(F.lit(1)).alias("n"))
    seen = {(r["before"], r["pos"]): r["n"] for r in steps.collect()}

    def step_costs(before: str | None) -> list[int]:
        n = [seen.get((before, t), 0) for t in tags]
        return [int(np.floor(SCALE * np.log((sum(n) + len(tags)) / (k + 1)))) for k in n]

    def word_cost(tag: str, n: Column) -> Column:
        return _cost(F.lit(float(of_tag[tag] + words)), n + 1) if tag in of_tag else F.lit(NEVER)

    by_tag = F.map_from_entries(F.collect_list(F.struct("pos", "n")))
    lexicon = counts.groupBy("word").agg(by_tag.alias("m")).select(
        "word", F.array(*[word_cost(t, F.coalesce(F.col("m")[t], F.lit(0))) for t in tags]).alias("costs")
    )
    return TagModel(
        tags,
        list(of_tag),
        stored(lexicon, "tag-costs"),
        np.array(step_costs(None), np.int64),
        np.array([step_costs(t) for t in tags], np.int64),
        [int(np.floor(SCALE * np.log(of_tag[t] + words))) if t in of_tag else NEVER for t in tags],
    )


def _unknown_costs(word: Column, model: TagModel) -> Column:
    """Costs of a word that was not learned: the tag of its shape if certain or learned, else any learned tag."""
    costs = F.when(F.lit(False), F.lit(None).cast("array<int>"))
    for pattern, tag in UNKNOWN_TAGS:
        if tag in CERTAIN_TAGS or tag in model.learned:
            only = [0 if t == tag else NEVER for t in model.tags]
        else:
            only = model.unknown
        costs = costs.when(F.rlike(word, F.lit(pattern)), F.array(*[F.lit(c) for c in only]))
    return costs.otherwise(F.array(*[F.lit(c) for c in model.unknown]))


def cheapest_tags(costs: np.ndarray, bounds: np.ndarray, start: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """Index of the tag of each token on the cheapest way through its sentence, ties by smaller index.

    Row ``i`` of ``costs`` holds the costs of all tags for token ``i``; ``bounds`` are the ends of the sentences. All
    sentences take a step at a time together, longest first, so those that still run are the first ones.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    sizes, first = sizes[order], bounds[:-1][order]
    longest = int(sizes[0]) if len(sizes) else 0
    running = [int(np.searchsorted(-sizes, -p, "left")) for p in range(longest)]
    total = np.zeros((len(sizes), len(start)), np.int64)
    back = np.zeros(costs.shape, np.int16)
    for p, n in enumerate(running):
        at = first[:n] + p
        if p == 0:
            total[:n] = start + costs[at]
            continue
        ways = total[:n, :, None] + follow
        back[at] = ways.argmin(axis=1)
        total[:n] = ways.min(axis=1) + costs[at]
    tag = total.argmin(axis=1)
    chosen = np.zeros(len(costs), np.int64)
    for p in range(longest - 1, -1, -1):
        n = running[p]
        at = first[:n] + p
        chosen[at] = tag[:n]
        tag[:n] = back[at, tag[:n]]
    return chosen


def tag_in_context(sentences: DataFrame, model: TagModel) -> DataFrame:
    """``doc_id, sentence, token, word, pos`` row per token of ``doc_id, sentence, result`` rows.

    Sentences are shuffled once by their key, before they become tokens; the costs of a word are looked up there, and
    sentences are put together again where they are. Repeated rows, also those of one id, give
    repeated results. Null and empty sentences have no tokens. A sentence and its costs fit into a task, as its text does.
    """
    keys = ["doc_id", "sentence", "digest"]
    once = sentences.withColumn("digest", F.sha2("result", 256)).groupBy(*keys).agg(
        F.first("result").alias("result"), F.count(F.lit(1)).alias("copies")
    )
    words = F.regexp_extract_all("result", F.lit(TOKEN), F.lit(0))
    tokens = once.select(*keys, "copies", F.posexplode(words).alias("token", "word"))
    lexicon = model.lexicon.withColumnRenamed("word", "_key")
    found = lookup_join(tokens.withColumn("_key", F.lower("word")), lexicon, "_key", "left")
    costs = F.coalesce("costs", _unknown_costs(F.col("_key"), model))
    parts = F.sort_array(F.collect_list(F.struct("token", "word", costs.alias("costs"))))
    whole = found.groupBy(*keys, "copies").agg(parts.alias("t")).select(
        "doc_id", "sentence", "copies", F.col("t.word").alias("words"), F.flatten("t.costs").alias("costs")
    )
    tags, start, follow = pa.array(model.tags), model.start, model.follow

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            sizes = words.value_lengths().to_numpy()
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            costs = batch.column("costs").flatten().to_numpy().reshape(-1, len(start))
            pos = tags.take(pa.array(cheapest_tags(costs, bounds, start, follow)))
            copies = batch.column("copies").to_numpy()
            # A token row for each copy of its sentence.
            rows = np.repeat(np.arange(len(sizes)), copies)
            count = sizes[rows]
            token = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = pa.array(np.repeat(bounds[rows], count) + token)
            row = pa.array(np.repeat(rows, count))
            columns = [
                batch.column("doc_id").take(row), batch.column("sentence").take(row),
                pa.array(token.astype(np.int32)), words.flatten().take(at), pos.take(at),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sentence", "token", "word", "pos"])

    types = {f.name: f.dataType.simpleString() for f in sentences.schema.fields}
    schema = f"doc_id {types['doc_id']}, sentence {types['sentence']}, token int, word string, pos string"
    return whole.mapInArrow(decode, schema)
