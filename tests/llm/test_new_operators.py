"""Hard negatives, line quality and collocations beside brute force."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.llm import line_quality, negatives, phrases

VECTORS = "vec_id long, label int, embedding array<float>, text string, rank string, block long"


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


# --- hard negatives ------------------------------------------------------------------------------


def brute_negatives(rows, is_anchor, positives=5, negatives_=3):
    kept = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for k, (i, label, v) in enumerate(kept):
        if not is_anchor(i):
            continue
        scores = [
            (-sum(a * b for a, b in zip(v, w)), j, other)
            for n, (j, other, w) in enumerate(kept)
            if n != k and len(w) == len(v)
        ]
        for s, p, _ in sorted(x for x in scores if x[2] == label)[:positives]:
            inside = sorted((t, j) for t, j, other in scores if other != label and -50 * s <= -100 * t <= -95 * s)
            out += [(i, p, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(inside[:negatives_])]
    return sorted(out, key=repr)


def vector_rows(seed, n, dim, labels, spread=1.0):
    rnd = random.Random(seed)
    centre = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rnd.randrange(labels) if i % 3 else 0
        rows.append((i, label, [0.5 + c + spread * rnd.gauss(0, 1) for c in centre[label]]))
    return rows


def as_floats(rows):
    import numpy as np

    return [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]


@pytest.mark.parametrize("block_bytes", [negatives.BLOCK_BYTES, 8 * 12 * 7])
def test_hard_negatives(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", block_bytes)
    rows = as_floats(vector_rows(1, 240, 12, 4))
    # Ties, repeated rows, shared ids, other lengths, and rows that take no part.
    rows += [rows[10], rows[10], (10, 2, rows[11][2]), (300, 1, rows[20][2]), (301, 1, rows[20][2]), (302, 0, rows[20][2])]
    rows += [(350, 1, [0.5] * 5), (351, 1, [0.5] * 5), (352, 2, [0.25] * 5), (400, 1, []), (401, 1, []), (402, 2, [])]
    rows += [(None, 1, rows[0][2]), (450, None, rows[0][2]), (451, 1, None), (452, 1, [None] * 12)]
    rows += [(453, 1, [float("nan")] + [1.0] * 11), (454, 1, [float("-inf")] * 12), (500, 7, rows[30][2])]
    frame = spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], VECTORS).repartition(3)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert collected(got) == want


def test_hard_negatives_of_great_components(spark):
    for factor in (1e6, 1e11):
        rows = [(i, label, [float(round(factor * x)) for x in v]) for i, label, v in vector_rows(2, 60, 2, 3)]
        rows = [r for r in rows if r[0] < 40] if factor == 1e6 else [(i, c, [x / 1000 for x in v]) for i, c, v in rows[:20]]
        frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
        want = brute_negatives(rows, lambda i: i % 5 == 0)
        if all(abs(r[4]) < 1 << 63 for r in want):
            assert want and collected(negatives.hard_negatives(frame, F.col("vec_id") % 5 == 0)) == want


def test_blocks_of_vectors_meet_without_broadcast_or_copies(spark, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", 2)
    rows = negatives.scaled_vectors(spark.createDataFrame(as_floats(vector_rows(3, 90, 4, 3)), "vec_id long, label int, embedding array<float>"))
    blocks = negatives.vector_blocks(rows, 8 * 4 * 5)
    anchors = negatives.vector_blocks(rows.where("vec_id % 10 = 0"), 8 * 4)
    pairs = negatives.block_pairs(negatives.as_anchors(anchors), blocks)
    got = pairs.select("a_block", "block").collect()
    assert len(got) == len(set(got)) == anchors.count() * blocks.count() and anchors.count() == 9
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and "CartesianProduct" in plan


def test_hard_negatives_of_no_rows(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0], "", "", 1)], VECTORS)
    assert negatives.hard_negatives(alone, F.col("vec_id") % 50 == 0).count() == 0


# --- line quality --------------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    base = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), base,
    )


PROSE = "The quick brown fox went over the lazy dog near the old river bank today.\n"
QUALITY = [
    None, "", " \n\t", "one two", PROSE, PROSE * 2, PROSE + "Home | About | Contact\n", "Home | About | News | Contact | Help | More\n" * 9,
    "a b c d e f g h i j k l m n o p", PROSE + "All rights reserved.", "é ü " * 40, "x " * 30000 + ".", "\x1c\x85   one\x0btwo\x0cthree\r\n" * 4,
    "a b c d e\nf g h i j.\na b c d e\nk l m n o.", "Menu\nSearch\nLogin\n" + PROSE, "#*$%&|<> " * 12,
]


def test_line_quality(spark):
    rows = [(i, t, 5, "clash") for i, t in enumerate(QUALITY)] + [(None, PROSE, 5, "clash"), (4, PROSE, 5, "clash")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    got = line_quality.line_quality(frame).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        counts = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert counts == brute_counts(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert kept == {4, 6, 9, 14, None}
    cleaned = {r["doc_id"]: r["cleaned"] for r in got}
    assert cleaned[6] == cleaned[14] == PROSE and cleaned[9] == PROSE.strip() and cleaned[0] is None and cleaned[1] == ""
    left = line_quality.clean_documents(frame)
    assert left.columns == frame.columns and {r["text"].strip() for r in left.collect()} == {PROSE.strip()}
    assert line_quality.line_quality(frame.limit(0)).count() == 0


def test_long_lines_are_read_word_by_word(monkeypatch):
    whole = line_quality.judge(PROSE * 5)
    monkeypatch.setattr(line_quality, "LONG_LINE", 3)
    assert line_quality.judge(PROSE * 5) == whole


# --- collocations --------------------------------------------------------------------------------


def brute_collocations(rows, least, top, longest=5):
    counts, n = {}, Counter()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            words = [w for w in re.split(r"[\x20\x09]", piece) if w]
            n[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        candidates = [p for p, a in own.items() if len(p) > 1 and a >= least]
        kept = []
        for p in candidates:
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(len(q) > len(p) and own[q] >= own[p] and inside(q) for q in candidates):
                continue
            score, k = min((1000 * own[p] * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -own[p], " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out, key=repr)


def phrase_rows(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß", "\x00z", "A-b", "x\xa0y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for i in range(n):
        words = rnd.choices(vocabulary, weights, k=rnd.randrange(0, 60))
        text = "".join(w + rnd.choice([" ", " ", " ", "\t ", ", ", ".\n", "  "]) for w in words)
        if i % 4 == 0:
            text += " New York City Hall opens today; new york city hall closes! so so so so so so"
        rows.append((text, rnd.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" \t\n", "fr"), ("w1 w2 " * 4000, "en"), ("w1 w2 " * 4000, "en")]


@pytest.mark.parametrize("batch, top", [(1 << 24, 2000), (6000, 2000), (3000, 5)])
def test_collocations(spark, batch, top):
    rows = phrase_rows(3, 400)
    frame = spark.createDataFrame([(t, x, "clash", 1, 2) for t, x in rows], "text string, lang string, phrase string, n int, f int")
    got = phrases.collocations(frame.repartition(3), least=10, top=top, batch=batch)
    want = brute_collocations(rows, 10, top)
    assert len(want) >= 9 and collected(got) == want


def test_settled_languages_are_not_expanded_further(spark, monkeypatch):
    """The rarest words hold the best phrases, so most first words are never grown."""
    grown, real = [], phrases.grown

    def counted(docs, words, *rest):
        grown.extend(r["phrase"] for r in words.collect())
        return real(docs, words, *rest)

    monkeypatch.setattr(phrases, "grown", counted)
    # A hundred rare pairs, and common words in any order.
    rnd = random.Random(4)
    rows = [(f"left{i} right{i}", "en") for i in range(100) for _ in range(12)]
    rows += [(" ".join(rnd.choices([f"c{i}" for i in range(30)], k=20)), "en") for _ in range(800)]
    frame = spark.createDataFrame(rows, "text string, lang string")
    got = collected(phrases.collocations(frame, least=10, top=50, batch=2400))
    assert got == brute_collocations(rows, 10, 50)
    assert sum(word.startswith("c") for word in grown) < 15


def test_collocations_of_no_rows(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(empty).count() == 0
    rare = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert phrases.collocations(rare).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(rare).count() == 0


def test_links_of_a_group_are_compared_as_a_tree_first(spark, monkeypatch):
    from textloom.llm import jaccard

    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(30)] + [(90, "a b c d e f g"), (91, "a b c d e f h")]
    compared, whole = [], jaccard.verified

    def counted(docs, pairs, *rest):
        compared.append(pairs.count())
        return whole(docs, pairs, *rest)

    monkeypatch.setattr(jaccard, "verified", counted)
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: 0 for i in range(30)} | {90: 90, 91: 91}
    assert sum(compared) < 60
    # The same with requests that are too many to be broadcast.
    monkeypatch.setattr(jaccard, "REQUESTS", 1)
    again = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_cuts_are_found_by_reading_gaps_only():
    import numpy as np

    from textloom.llm import phrases

    text = b"a b.c ,d \t e" + b" " * 40 + b"f" + b" " * 30 + b";" + b" " * 30 + b"g  . h\ti" + b" " * 7 + b"!j" + b" " * 9 + b"k"
    raw = np.frombuffer(text, np.uint8)
    first = np.array([i for i, x in enumerate(text) if chr(x).isalpha()])
    last = first[:-1] + 1
    expected = [any(phrases.IS_CUT[x] for x in text[a:b]) for a, b in zip(last, first[1:])]
    assert phrases.cut_between(raw, last, first[1:]).tolist() == expected
    slab = phrases.Slab(raw, np.array([0, len(raw)]), np.zeros(1, np.uint64))
    assert slab.piece.tolist() == np.cumsum([0, *expected]).tolist()
    # Only the bytes of words that are returned are written in lower case.
    assert np.shares_memory(slab.raw, raw)
