"""Edge cases and brute-force comparisons of the training-data operators on small frames."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import (
    chat,
    decontaminate,
    exact,
    jaccard,
    language,
    lines,
    packing,
    repeats,
    token_files,
    tokenize,
    toxicity,
)
from textloom.llm.common import UPPER, LOWER, arrow_text, components
from textloom.llm.queries import QUERIES, TOKENIZER

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, score string, rank int"


def folded(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(n))


def with_edit(text, at, word="edited"):
    words = text.split(" ")
    words[at] = word
    return " ".join(words)


LONG = prose(1, 4000)
TEXTS = [
    (1, "The quick Fox"), (2, "the quick fox"), (3, None), (4, ""), (5, "   \n\t "), (6, "!!! ???"), (7, LONG),
    (8, LONG), (9, with_edit(LONG, 2000)), (10, LONG.upper()), (10, LONG.upper()), (11, "a b"), (12, "a b"), (12, "c"),
    (None, "no id"), (None, None), (13, "x\x00y  z Été퟿ 日本"), (14, "'s don't <|endoftext|>  two  blanks\n\nend "),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, "clash", "clash", 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_exact_duplicates(docs, empty):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[folded(t)].append(i)
    want = []
    for i, t in TEXTS:
        own = groups[folded(t)]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(folded(t).encode()).hexdigest()))
    assert collected(exact.exact_duplicates(docs, 64, 256)) == sorted(want, key=repr)
    assert exact.exact_duplicates(empty).count() == 0
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert len({folded(r["text"]) for r in kept.collect()}) == kept.count() == len(groups)


def test_repeated_rows_of_one_document(spark):
    rows = [(3, "q", 1), (3, "q", 2), (4, "Q", 3), (4, "Q", 3), (5, "z", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _kept_id int")
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(frame.drop("_kept_id")).collect()]
    assert sorted(got) == [(3, 4, 4, False)] * 2 + [(4, 4, 4, True)] * 2 + [(5, 5, 1, True)]
    for name in ("_kept_id", "_text"):
        left = exact.drop_exact_duplicates(frame.withColumnRenamed("_kept_id", name))
        assert left.columns == ["doc_id", "text", name] and collected(left) == [(4, "Q", 3), (5, "z", 1)]


def test_chunks_cover_the_text(docs):
    rows = exact.chunk_texts(docs.where("doc_id = 9"), 64, 256).orderBy("pos").collect()
    assert "".join(r["chunk"] for r in rows) == folded(TEXTS[8][1]) and len(rows) > 10


def test_encoder_is_the_tokenizer():
    texts = [t for _, t in TEXTS if t is None or "퟿" not in t] + ["é x×y", "a \n b", "x\ny z\n", "1a2!b", " a"]
    own = tokenize.Encoder(TOKENIZER)
    want = own.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for _ in range(2):
        assert all(np.array_equal(a, b.ids) for a, b in zip(own.encode(*arrow_text(pa.array(texts))), want))


def test_encoder_with_more_pieces_than_it_keeps(monkeypatch):
    monkeypatch.setattr(tokenize, "MAX_PIECES", 5)
    own = tokenize.Encoder(TOKENIZER)
    for texts in (["one two three"], ["one four five six seven eight nine ten two"], ["four", "two eleven"]):
        want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert all(np.array_equal(a, b.ids) for a, b in zip(own.encode(*arrow_text(pa.array(texts))), want))


def thue_morse(x, y, n=1024):
    return "".join((x, y)[bin(i).count("1") % 2] for i in range(n))


def test_words_that_collide_modulo_powers_of_two(spark):
    """Two words of 1,024 letters have one hash in any polynomial modulo 2^64."""
    one, two = thue_morse("a", "b"), thue_morse("b", "a")
    texts = [one, two, "x " + one, two + " y"]
    own = tokenize.Encoder(TOKENIZER)
    want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(np.array_equal(a, b.ids) for a, b in zip(own.encode(*arrow_text(pa.array(texts))), want))
    frame = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(frame).collect()}
    assert found == {1: 1, 2: 2, 3: 1}


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(tokenize.RunHasher, "__call__", lambda self, first, last: (last - first).astype(np.uint64))
    texts = ["one two six", "ten one", "", "two"]
    own = tokenize.Encoder(TOKENIZER)
    want = own.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(np.array_equal(a, b.ids) for a, b in zip(own.encode(*arrow_text(pa.array(texts))), want))


def encoded(text):
    tokenizer = tokenize.encoder(TOKENIZER).tokenizer
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_token_files(spark, docs, empty, tmp_path):
    path = f"file://{tmp_path}/files"
    written = token_files.write_token_files(docs, path, TOKENIZER, parts=3)
    read = token_files.read_token_files(spark, path, with_ids=True).collect()
    assert collected(written) == sorted(((r["doc_id"], r["start"], r["n_tokens"]) for r in read), key=repr)
    read = sorted(read, key=lambda r: r["start"])
    order = [r["doc_id"] for r in read]
    assert order[:2] == [None, None] and order[2:] == sorted(order[2:])
    begin, left = 0, [(i, encoded(t).tolist()) for i, t in TEXTS]
    for r in read:
        ids = r["ids"]
        left.remove((r["doc_id"], ids))
        assert r["start"] == begin and r["n_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        begin += len(ids)
    assert not left and token_files.read_manifest(path)["dtype"] == "<u2"
    token_files.write_token_files(empty, f"{path}-empty", TOKENIZER)
    assert token_files.read_token_files(spark, f"{path}-empty").count() == 0


def check_packing(rows, wanted, capacity):
    """Every token of every document has one place, and sequences are filled without gaps."""
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_bin[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_bin.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    crcs = defaultdict(list)
    for i, ids in wanted:
        begin = 0
        for n in packing.cut_lengths(len(ids), capacity):
            crcs[i].append((begin, n, zlib.crc32(ids[begin : begin + n].tobytes())))
            begin += n
    assert {i: sorted((r["start"], r["length"], r["ids_crc32"]) for r in x) for i, x in by_doc.items()} == {
        i: sorted(x) for i, x in crcs.items()
    }
    return len(by_bin)


def test_packing(docs, empty):
    wanted = [(i, encoded(t)) for i, t in TEXTS]
    bins = check_packing(packing.pack_documents(docs, TOKENIZER).collect(), wanted, 1024)
    assert bins <= -(-sum(len(x) for _, x in wanted) // 1024) + 1
    assert packing.pack_documents(empty, TOKENIZER).count() == 0
    assert packing.cut_lengths(2050, 1024) == [2, 1024, 1024] and packing.cut_lengths(1024, 1024) == [1024]


def least_bins(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for b in sorted({x for x in bins if x >= items[i]}):
            k = bins.index(b)
            place(i + 1, [*bins[:k], b - items[i], *bins[k + 1 :]])
        place(i + 1, [*bins, capacity - items[i]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best


def test_reduction_keeps_an_optimal_packing():
    draw = random.Random(3)
    for _ in range(150):
        capacity = draw.randint(5, 30)
        items = [draw.randint(1, capacity) for _ in range(draw.randint(1, 9))]
        counts = {s: items.count(s) for s in set(items)}
        plan = packing._Plan(counts, capacity)
        plan.reduce()
        rest = [s for s in range(capacity + 1) for _ in range(int(plan.left[s]))]
        assert plan.fixed_bins + (least_bins(rest, capacity) if rest else 0) == least_bins(items, capacity)
        runs, bins, _ = packing.plan_packing(counts, capacity)
        assert least_bins(items, capacity) <= bins <= least_bins(items, capacity) + 1


def brute_hits(text, items, window=13):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, found = pattern.findall(folded(text)), set(), set()
    for item, body in items:
        own = pattern.findall(folded(body))
        for i in range(max(1, len(own) - window + 1) if own else 0):
            gram = own[i : i + window]
            for j in range(len(words) - len(gram) + 1):
                if words[j : j + len(gram)] == gram:
                    hit.update(range(j, j + len(gram)))
                    found.add(str(item))
    names = ",".join(sorted(found))
    n = len(hit)
    return len(words), n, len(found), hashlib.sha256(names.encode()).hexdigest(), n > 0 and 20 * n >= len(words)


def test_contamination(spark, docs, empty):
    items = [(1, prose(5, 30)), (2, "quick FOX"), (3, None), (4, "..."), (5, prose(5, 13)), (5, prose(5, 13)), (6, "été 日本")]
    benchmark = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, hits string")
    passage = prose(5, 30).replace(" ", ",\n").upper()
    rows = [*TEXTS, (20, f"{prose(6, 40)} {passage} {prose(7, 20)}"), (21, prose(5, 20)), (22, LONG + " quick--fox")]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (decontaminate.BLOCK_BYTES, 2000):
        hits = decontaminate.contamination_hits(more, benchmark, block_bytes=block)
        assert hits.count() == len(rows)
    got = decontaminate.contamination(more, benchmark)
    want = sorted(((i, *brute_hits(t, items)) for i, t in rows), key=repr)
    assert collected(got.drop("spans")) == want
    text = next(t for i, t in rows if i == 20)
    (span,) = got.where("doc_id = 20").first()["spans"]
    assert text.encode()[span["first"] : span["last"]].decode() == passage
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert not decontaminate.contamination(docs, benchmark.limit(0)).where("n_hit > 0").count()


def brute_components(rows, words, percent):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", folded(t))
        n = min(words, len(w))
        sets.append((i, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    low = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        low[root(k)].append(i)
    return [(i, len(s), min(low[root(k)])) for k, (i, s) in enumerate(sets)]


def test_near_duplicates(spark, empty):
    base = prose(9, 60)
    rows = [(i, t) for i, t in TEXTS if i is not None]
    draw = random.Random(4)
    rows += [(100 + k, with_edit(base, draw.randrange(60), f"w{k}")) for k in range(40)]
    rows += [(200 + k, with_edit(with_edit(base, draw.randrange(60), f"u{k}"), draw.randrange(60), "v")) for k in range(40)]
    rows += [(300 + k, prose(9, 12) + " " + prose(50 + k, 30)) for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit(0))
    for words, percent in ((4, 85), (5, 80)):
        got = collected(jaccard.near_duplicates(frame, words, percent))
        assert got == sorted(brute_components(rows, words, percent), key=repr)
    assert jaccard.near_duplicates(empty).count() == 0


def test_near_duplicates_of_a_shared_id(spark):
    """One of two texts under an id is a near copy of another document; the other keeps one of its own group."""
    one, two = prose(70, 60), prose(71, 60)
    rows = [(1, one), (2, with_edit(one, 59, "z")), (2, two), (5, with_edit(two, 59, "ever"))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    clash = jaccard.drop_near_duplicates(frame.withColumn("_kept_id", F.lit(1)))
    assert clash.columns == ["doc_id", "text", "_kept_id"] and clash.count() == 2
    assert collected(jaccard.drop_near_duplicates(frame)) == sorted([(1, one), (2, two)], key=repr)
    assert collected(jaccard.near_duplicates(frame)) == sorted(brute_components(rows, 5, 80), key=repr)


def test_near_duplicates_without_id(docs):
    got = jaccard.near_duplicates(docs).where("doc_id is null").collect()
    assert len(got) == 2 and all(r["component_id"] is None for r in got)


def test_components(spark):
    draw = random.Random(8)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(150)] + [(1000, 1000 + k) for k in range(1, 50)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def covered(rows, least):
    """Words of each document inside runs of ``least`` words that stand in another document."""
    where, words = defaultdict(set), {}
    for i, t in rows:
        words[i] = re.findall(r"[^\x20\x09-\x0D]+", folded(t))
        for k in range(len(words[i]) - least + 1):
            where[tuple(words[i][k : k + least])].add(i)
    out = {}
    for i, w in words.items():
        hit = set()
        for k in range(len(w) - least + 1):
            if len(where[tuple(w[k : k + least])]) > 1:
                hit.update(range(k, k + least))
        out[i] = hit
    return out


def test_repeated_passages(spark, empty):
    passages = [prose(60 + k, 55 + 20 * k) for k in range(5)]
    rows = [(k, f"{prose(100 + k, 40 + 7 * k)} {passages[k % 5]}\n{prose(200 + k, 30)}") for k in range(30)]
    rows += [(40, None), (41, ""), (42, prose(60, 49)), (43, LONG), (44, LONG), (45, f"é {LONG}"), (46, passages[0].upper())]
    rows += [(47, " ".join([prose(80, 60)] * 3)), (None, LONG)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("head", F.lit("clash"))
    got, texts = defaultdict(set), dict(rows)
    for r in repeats.repeated_passages(frame).collect():
        got[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
        part = texts[r["doc_id"]][r["first_char"] : r["last_char"]]
        assert len(part.split()) == r["n_words"] and r["with_doc"] != r["doc_id"]
    want = covered([x for x in rows if x[0] is not None], 50)
    assert got == {i: x for i, x in want.items() if x}
    assert repeats.repeated_passages(empty).count() == 0


@pytest.fixture
def many_ranges(spark):
    """Partitions of a shuffle stay as they are, however small."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def check_passages(frame, rows):
    got = defaultdict(set)
    for r in repeats.repeated_passages(frame).collect():
        got[r["doc_id"]].update(range(r["first_word"], r["first_word"] + r["n_words"]))
    want = {i: x for i, x in covered(rows, 50).items() if x}
    assert {i: len(x) for i, x in got.items()} == {i: len(x) for i, x in want.items()}
    assert got == want


def test_passage_repeated_many_times_in_one_document(spark, many_ranges):
    passage = prose(90, 60)
    rows = [(1, " ".join(f"{passage} {prose(5000 + k, 60)}" for k in range(600))), (2, f"{prose(91, 30)} {passage}")]
    check_passages(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_passage_whose_words_behind_stand_in_many_documents(spark):
    common = prose(92, 40)
    rows = [(k, f"{prose(6000 + k, 30)} {common} {prose(7000 + k, 30)}") for k in range(400)]
    for k in range(30):
        own = prose(8000 + k, 20)
        rows += [(1000 + 2 * k + n, f"{prose(9000 + 2 * k + n, 30)} {own} {common} {prose(9500 + 2 * k + n, 30)}") for n in (0, 1)]
    check_passages(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_passage_names_the_smallest_other_document(spark):
    passage = prose(93, 60)
    rows = [(k, f"{prose(9700 + k, 30)} {passage}") for k in (9, 3, 7, 5)] + [(3, f"{passage} {prose(9800, 70)} {passage}")]
    frame = repeats.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r["doc_id"], r["with_doc"], r["seen_before"]) for r in frame.collect()} == {(3, 5, False), (5, 3, True), (7, 3, True), (9, 3, True)}


def edit_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    q = 0
    while q < min(len(a), len(b)) - p and a[-1 - q] == b[-1 - q]:
        q += 1
    return p + q >= max(len(a), len(b)) - 1


def test_line_dedup(spark, empty):
    draw = random.Random(2)
    base = [prose(300 + k, n) for k, n in enumerate((3, 8, 12, 13, 14, 30, 60))]
    base += ["y" * n for n in (15, 16, 63, 64, 65, 128, 129)]
    pool = list(base)
    for line in base:
        for _ in range(4):
            k = draw.randrange(len(line))
            pool.append(draw.choice([line[:k] + line[k + 1 :], line[:k] + "Z" + line[k:], line[:k] + "é" + line[k + 1 :]]))
        pool += [line + "!", line[:-1]]
    rows = [(i, "\n".join(draw.choices(pool, k=8))) for i in range(30)]
    rows += [(50, None), (51, ""), (52, "\n \n\t"), (53, " " + base[2] + " \n" + base[2]), (None, base[3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    places = {}
    for i, t in sorted(rows, key=lambda x: -1 if x[0] is None else x[0]):
        for k, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\r"):
                places.setdefault(line.strip(" \t\r"), (-1 if i is None else i, k))
    ordered = sorted(places, key=places.get)
    near = {
        b
        for n, b in enumerate(ordered)
        if len(b) >= lines.MIN_CHARS and any(len(a) >= lines.MIN_CHARS and edit_at_most_one(a, b) for a in ordered[:n])
    }
    want = []
    for i, t in rows:
        kept, n, gone, close = [], 0, 0, 0
        for k, line in enumerate(t.split("\n") if t is not None else []):
            own = line.strip(" \t\r")
            n += bool(own)
            again = bool(own) and (own in near or places[own] != (-1 if i is None else i, k))
            gone, close = gone + again, close + (own in near)
            if not again:
                kept.append(line)
        want.append((i, n, gone, close, "\n".join(kept) if t is not None else None))
    assert collected(lines.dedup_lines(frame)) == sorted(want, key=repr)
    assert len(near) > 20 and lines.dedup_lines(empty).count() == 0


def test_line_dedup_of_rows_that_share_an_id(spark):
    shared, close = prose(400, 8), prose(401, 8)
    rows = [(None, f"{prose(410 + k, 4)}\n{shared if k % 2 else prose(420 + k, 4)}\n{prose(430 + k, 4)}") for k in range(6)]
    rows += [(7, "\n".join(prose(440 + k, 4) for k in range(9)) + f"\n{close}x\n{shared}"), (7, prose(450, 4)), (7, f"{close}y")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = [line for _, t in rows for line in t.split("\n")]
    kept = sorted(line for r in got for line in r["text"].split("\n") if line)
    assert len(kept) == len(set(texts)) - 1 and set(texts) - set(kept) < {f"{close}x", f"{close}y"}
    assert sum(r["n_lines"] for r in got) == len(texts) and sum(r["n_near"] for r in got) == 1
    assert all(r["n_lines"] - r["n_dropped"] == len([x for x in r["text"].split("\n") if x]) for r in got)
    assert sorted((r["doc_id"] or 0) for r in got) == [0] * 6 + [7] * 3


def test_rotation(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob b", "hey <|im_end|>"), (1, 3, "ann", None),
        (1, 3, "ann", None), (1, 3, "cy", "é"), (2, 0, None, "who"), (3, 0, "system", "x"), (None, 0, "ann", "lost"),
    ]
    frame = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, part string")
    for size in (1000, 2):
        got = chat.rotated_dialogues(frame, part_turns=size).collect()
        assert {(r["conv_id"], r["perspective"]) for r in got} == {(1, "ann"), (1, "bob b"), (1, "cy"), (None, "ann")}
        whole = defaultdict(list)
        for r in sorted(got, key=lambda r: r["part"]):
            assert r["n_turns"] <= size
            for m in r["mask"]:
                whole[r["conv_id"], r["perspective"]].append(r["text"][m["first"] : m["last"]])
        assert whole[1, "ann"] == ["hi<|im_end|>", "<|im_end|>"] and whole[1, "cy"] == ["é<|im_end|>"]
        assert whole[1, "bob b"] == ["hey < |im_end|><|im_end|>"]
        text = "".join(r["text"] for r in sorted(got, key=lambda r: r["part"]) if r["perspective"] == "cy")
        assert text == (
            "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
            "<|im_start|>user name=bob_b\nhey < |im_end|><|im_end|>\n<|im_start|>user name=ann\n<|im_end|>\n"
            "<|im_start|>assistant\né<|im_end|>\n"
        )
    assert chat.rotated_dialogues(frame.limit(0)).count() == 0


def test_codewords():
    for n in (2, 3, 4, 7, 12):
        code = language.codewords(n).astype(int)
        apart = (code.shape[1] - code @ code.T) // 2
        assert apart[~np.eye(n, dtype=bool)].min() >= max(1, code.shape[1] // 4)


def test_language_accuracy(spark, empty):
    found = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


def test_language_edges(docs, empty):
    model = language.fit_languages(docs)
    got = language.identify_languages(docs, model).collect()
    texts = sorted((repr(r["doc_id"]), r["lang_pred"]) for r in got)
    assert len(got) == len(TEXTS)
    assert texts == sorted((repr(i), "en" if t and any(c.isalpha() for c in t) else "und") for i, t in TEXTS)
    none = language.fit_languages(empty)
    assert {r["lang_pred"] for r in language.identify_languages(docs, none).collect()} == {"und"}
    assert language.identify_languages(empty, model).count() == 0


def test_toxicity_learns_words_and_stems(spark, docs, empty):
    draw = random.Random(5)
    rows = []
    for k in range(600):
        words = prose(1000 + k, draw.randint(5, 60)).split(" ")
        if k % 4 == 0:
            words[draw.randrange(len(words))] = draw.choice(["vilest", "zzork" + "".join(draw.choices("abcdefgh", k=3))])
        rows.append((k, " ".join(words), draw.choice(["en", "de", None]), int(k % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.fit_toxicity(frame, frame.where("doc_id < 400"), min_calibration_rows=10)
    got = toxicity.score_toxicity(frame.where("doc_id >= 400"), model).join(frame.select("doc_id", "toxic"), "doc_id").collect()
    right = sum((r["score"] >= 0.3) == (r["toxic"] == 1) for r in got)
    assert right >= 0.9 * len(got) and set(model.thresholds) <= {"en", "de"}
    edge = toxicity.score_toxicity(docs, model).collect()
    assert len(edge) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in edge)
    assert toxicity.score_toxicity(empty, model).count() == 0
    one_class = toxicity.fit_toxicity(frame, frame.where("toxic = 0"))
    assert not toxicity.score_toxicity(frame, one_class).where("score >= 0.3").count()


def labelled_texts(spark, n=600):
    rows = [(k, prose(5000 + k, 12) + (" vilest" if k % 4 == 0 else ""), "en", int(k % 4 == 0)) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_toxicity_is_learnt_from_every_labelled_row(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 20)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 2000)
    for name in ("POSITIVE_ROWS", "NEGATIVE_ROWS"):  # there is no bound on the rows; what was one has no effect
        monkeypatch.setattr(toxicity, name, 10, raising=False)
    frame, seen = labelled_texts(spark), []
    keep = toxicity.fit_shards
    monkeypatch.setattr(toxicity, "fit_shards", lambda blocks, *a: seen.append(blocks) or keep(blocks, *a))
    toxicity.fit_toxicity(frame.unionByName(frame.limit(3)), frame)
    blocks = seen[0].collect()
    rows = sum(len(r["toxic"]) for r in blocks)
    held = frame.where(F.shiftright(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(toxicity.SEED)), 12), 20) % 5 == 4).count()
    assert 600 - held <= rows <= 603 - held and 90 < held < 150
    assert len({r["shard"] for r in blocks}) == len(blocks) > 5
    assert sum(sum(r["toxic"]) for r in blocks) > 100


def test_shards_of_labels_learn_together_and_the_same_for_any_partitions(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 200)
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 100)
    frame = labelled_texts(spark)
    known = frame.where("doc_id < 500")
    models = [toxicity.fit_toxicity(frame.repartition(n), known.repartition(n)) for n in (1, 7)]
    assert all((a == b).all() for a, b in zip(*([m.table, *m.kernels, m.dense] for m in models)))
    got = toxicity.score_toxicity(frame.where("doc_id >= 500"), models[0], ("toxic",)).groupBy("toxic").avg("score")
    means = {r["toxic"]: r["avg(score)"] for r in got.collect()}
    assert means[1] > 2 * means[0]


def test_long_text_is_scored_in_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.fit_network([rng.integers(0, 1 << 17, (5, 3)).astype(np.int32) for _ in range(8)], np.array([0, 1] * 4, np.float32), 0.5)
    words, bounds = rng.integers(0, 1 << 17, (500, 3)).astype(np.int32), np.array([0, 3, 3, 480, 500])
    whole = model.score(words, bounds)
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    assert np.allclose(whole, model.score(words, bounds), atol=1e-6)


def test_pipeline_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    model = language.fit_languages(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    texts = pa.array([r["text"] for r in rows])
    features = language.as_features(np.stack(list(language.gram_counts(*arrow_text(texts)))))
    close = model.decode(features)[2]
    kept = [(r["doc_id"], r["text"]) for r, c in zip(rows, close) if not c and any(map(str.isalpha, r["text"] or ""))]
    last = {}
    for i, t in kept:
        last[folded(t)] = max(i, last.get(folded(t), i))
    kept = [(i, t) for i, t in kept if last[folded(t)] == i]
    stay = {i for i, _, low in brute_components(kept, 5, 80) if i == low}
    kept = [(i, t) for i, t in kept if i in stay and not brute_hits(t, items)[4]]
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packing(packed, [(i, encoded(t)) for i, t in kept], 1024)


def test_stages_keep_the_columns(spark, docs):
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in TEXTS], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, frame, SF_DIR).columns == frame.columns
        assert stage(spark, frame.limit(0), SF_DIR).count() == 0


def test_segments_take_the_length_of_a_line_as_a_column(spark):
    from textloom.llm.lines import segments

    texts = [(x,) for x in ("a" * 16, "né " * 30, "one long line " * 90)]
    rows = spark.createDataFrame(texts, "line string").withColumn("size", F.char_length("line"))
    for longer in (False, True):
        given = segments(F.col("line"), longer, F.col("size"))
        assert str(rows.select(given.alias("s"))._jdf.queryExecution().analyzed()).count("char_length") <= 1
        got = rows.select((given == segments(F.col("line"), longer)).alias("same"), F.size(given).alias("n")).collect()
        assert all(r["same"] and r["n"] >= 1 for r in got)


def test_group_of_many_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    draw = random.Random(5)
    rows = []
    for i in range(240):
        words = [f"w{k}" for k in range(100)]
        for k in draw.sample(range(100), 6):
            words[k] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    compared = []

    def counted(docs, pairs, words, percent, verified=jaccard.verified):
        compared.append(pairs.count())
        return verified(docs, pairs, words, percent)

    monkeypatch.setattr(jaccard, "verified", counted)
    got = collected(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80))
    assert got == sorted(brute_components(rows, 1, 80), key=repr)
    # There are 28,680 pairs; the first comparisons grow with the rows, and few are left for the last one.
    assert compared[-1] < 1000
