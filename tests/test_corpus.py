import os
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from textloom.functions.stemmer import porter2
from textloom.functions.text import default_stop_words
from textloom.operators import corpus, filters, joins, tokens
from textloom.plans import analyze
from textloom.plans.analyze import analyze_text, process_documents
from textloom.session import job_dir, scratch_path
from textloom.sources import readers, writers

random.seed(7)
WORDS = [f"w{i}" for i in range(60)]
DOCS = [(i, " ".join(random.choices(WORDS, weights=range(60, 0, -1), k=random.randint(0, 40)))) for i in range(50)]
TEXTS = [
    (0, "Running dogs run. The dog runs, running again!"),
    (1, "A dog's life: dogs and the happy running."),
    (2, "Unique zebra."),
    (3, "the of and"),
    (4, ""),
    (5, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def counts_of(docs):
    return tokens.word_counts(docs).withColumnRenamed("word", "term")


def test_rank_equals_a_full_sort_with_ties_split_over_partitions(spark):
    rows = [(random.choice([1, 1, 1, 2, 3]), f"t{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "cf long, term string").repartition(5)
    got = corpus.with_rank(df, F.desc("cf"), F.asc("term")).orderBy("index").collect()
    want = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [(r["cf"], r["term"], r["index"]) for r in got] == [(c, t, i) for i, (c, t) in enumerate(want)]


def test_counts_of_rows_equal_counts_in_place(docs):
    rows = tokens.word_rows(docs).withColumn("stem", F.col("word"))
    in_place = counts_of(docs)
    by_rows = corpus.doc_term_counts(rows)
    assert in_place.exceptAll(by_rows).isEmpty() and by_rows.exceptAll(in_place).isEmpty()
    assert by_rows.agg(F.sum("n")).first()[0] == sum(len(t.split()) for _, t in DOCS)


def test_vocabulary_equals_the_count_vectorizer(docs):
    vocab = {r["term"]: r for r in corpus.vocabulary_fit(counts_of(docs), 5).collect()}
    arrays = docs.select(F.split("text", " ").alias("w"))
    model = CountVectorizer(inputCol="w", outputCol="f", minDF=5).fit(arrays.select(F.array_remove("w", "").alias("w")))
    assert set(vocab) == set(model.vocabulary)
    assert sorted(r["index"] for r in vocab.values()) == list(range(len(vocab)))
    order = sorted(vocab.values(), key=lambda r: r["index"])
    assert order == sorted(order, key=lambda r: (-r["cf"], r["term"]))


def test_vocabulary_size_limit_keeps_the_most_frequent(docs):
    whole = corpus.vocabulary_fit(counts_of(docs), 1).orderBy("index").collect()
    cut = corpus.vocabulary_fit(counts_of(docs), 1, max_size=7).orderBy("index").collect()
    assert cut == whole[:7]


def test_features_do_not_depend_on_partitions(docs):
    def result(frame):
        counts = counts_of(frame)
        vocab = corpus.vocabulary_fit(counts, 2)
        return sorted(map(repr, corpus.doc_features(counts, vocab, "c").collect()))

    assert result(docs.repartition(1)) == result(docs.repartition(13))


def test_features_of_a_document_without_known_terms(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, "z"), (4, "")], "doc_id long, text string")
    counts = counts_of(docs)
    got = corpus.doc_features(counts, corpus.vocabulary_fit(counts, 2), "c").orderBy("d").collect()
    assert [tuple(r) for r in got] == [(1, [0], [1], "c"), (2, [0], [1], "c"), (3, [], [], "c")]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_a_large_lookup_broadcasts_hot_keys_only_and_joins_the_same(spark, how):
    keys = ["hot" if i % 3 else f"k{i}" for i in range(3000)] + [None] * 600
    rows = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    lookup = spark.createDataFrame([("hot", 1), ("k0", 2), ("none", 3)], "key string, v int")
    small = joins.lookup_join(rows, lookup, "key", how)
    large = joins.lookup_join(rows, lookup, "key", how, max_bytes=0)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" not in plan and "Union" in plan and plan.count("strategy=broadcast") >= 3
    assert sorted(small.columns) == sorted(large.columns)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.select(small.columns).collect()))


def test_lookup_size_counts_strings_numbers_and_arrays(spark):
    df = spark.createDataFrame([("abc", 1, ["x"]), (None, None, None)], "a string, b long, c array<string>")
    assert joins.lookup_bytes(df) >= 2 * 48 + 3 + 1
    assert joins.lookup_bytes(df.where("false")) == 0


def test_stop_word_rows_are_case_sensitive_and_the_join_agrees(spark):
    rows = spark.createDataFrame([("the",), ("The",), ("dog",)], "word string")
    stops = spark.createDataFrame([("the",), ("a",)], "word string")
    kept = [r["word"] for r in filters.without_stopword_rows(rows, ["the", "a"]).collect()]
    assert sorted(kept) == ["The", "dog"]
    assert sorted(r["word"] for r in filters.stopword_anti_join(rows, stops).collect()) == ["The", "dog"]
    loose = filters.without_stopword_rows(rows, ["the"], case_sensitive=False)
    assert [r["word"] for r in loose.collect()] == ["dog"]


def brute(texts, stem, bigrams, min_df):
    """The analysis in plain Python."""
    stops = set(default_stop_words())
    rows = []
    for doc, text in texts:
        kept = [w for w in re.findall(r"(?a)\w+", (text or "").lower()) if w not in stops]
        rows += [(doc, w, stem(w)) for w in kept]
        if bigrams:
            rows += [(doc, f"{a} {b}", f"{a} {b}") for a, b in zip(kept, kept[1:])]
    cf, df, forms = Counter(), defaultdict(set), defaultdict(set)
    for doc, word, s in rows:
        cf[s] += 1
        df[s].add(doc)
        forms[s].add(word)
    terms = sorted((s for s in cf if len(df[s]) >= min_df), key=lambda s: (-cf[s], s))
    index = {s: i for i, s in enumerate(terms)}
    per_doc = Counter((d, index[s]) for d, _, s in rows if s in index)
    features = {}
    for doc in {d for d, _, _ in rows}:
        pairs = sorted((i, n) for (d, i), n in per_doc.items() if d == doc)
        features[doc] = ([i for i, _ in pairs], [n for _, n in pairs])
    ngrams = {s: (sorted(forms[s]), cf[s], index[s], min(forms[s])) for s in terms}
    return features, ngrams


@pytest.mark.parametrize("bigrams", [False, True])
@pytest.mark.parametrize("min_df", [1, 2])
def test_analysis_equals_plain_python(texts, bigrams, min_df):
    features, ngrams = analyze_text(texts, "c9", bigrams=bigrams, min_df=min_df)
    want_features, want_ngrams = brute(TEXTS, porter2, bigrams, min_df)
    assert {r["d"]: (r["indexes"], r["counts"]) for r in features.collect()} == want_features
    assert {r["cId"] for r in features.collect()} == {"c9"}
    got = {r["stem"]: (r["unstemmed"], r["count"], r["index"], r["word"]) for r in ngrams.collect()}
    assert got == want_ngrams


def test_analysis_adds_up_rows_of_one_id(spark, texts):
    doubled = texts.unionByName(texts)
    features, ngrams = analyze_text(doubled, "c", bigrams=True, min_df=1)
    want, want_ngrams = brute(TEXTS + TEXTS, porter2, True, 1)
    assert {r["d"]: (r["indexes"], r["counts"]) for r in features.collect()} == want
    assert {r["stem"]: r["count"] for r in ngrams.collect()} == {s: v[1] for s, v in want_ngrams.items()}


def test_doc_stems_rows(texts):
    got = Counter(map(tuple, tokens.doc_stems(texts, default_stop_words(), bigrams=True).collect()))
    assert got[("dogs", 0, "dog")] == 1 and got[("running", 0, "run")] == 2 and got[("unique zebra", 2, "unique zebra")] == 1
    assert not [k for k in got if k[1] in (3, 4, 5)]
    alone = tokens.doc_stems(texts, default_stop_words())
    assert alone.where(F.contains("word", F.lit(" "))).isEmpty()


def test_process_documents_fills_both_collections(spark):
    source, target = scratch_path(spark, "docs"), scratch_path(spark, "out")
    schema = "docIndex long, text string, mongoSetId struct<oid: string>"
    rows = [(d, t, ("s1",)) for d, t in TEXTS] + [(9, "other set", ("s2",)), (10, "none", None)]
    spark.createDataFrame(rows, schema).write.json(source)
    process_documents(spark, "s1", "c7", "json", source, target, schema, min_df=1)
    features = spark.read.json(f"{target}/{writers.FEATURE_COLLECTION}")
    ngrams = spark.read.json(f"{target}/{writers.NGRAM_COLLECTION}")
    want, want_ngrams = brute(TEXTS, porter2, False, 1)
    assert {r["d"]: (r["indexes"], r["counts"]) for r in features.collect()} == want
    assert {r["stem"] for r in ngrams.collect()} == set(want_ngrams)
    assert {r["classifierId"]["oid"] for r in ngrams.collect()} == {"c7"}


def test_rows_without_a_classifier_are_not_saved(spark):
    ngrams = spark.createDataFrame([("a",)], "stem string")
    assert writers.ngrams_with_id(ngrams, None).isEmpty()
    assert writers.ngrams_with_id(ngrams, "c").first()["classifierId"]["oid"] == "c"


def test_csv_documents(spark, tmp_path):
    path = tmp_path / "docs.csv"
    path.write_text('docIndex,Item Type,Publication Year,Author,Title,Publication Title,text\n'
                    '0,a,2001,"B, C",T,P,"said ""x"", then"\n1,a,2002,D,T,P,\n', encoding="utf-8")
    got = readers.read_csv_documents(spark, str(path)).collect()
    assert [(r["docIndex"], r["Author"], r["Publication Year"], r["text"]) for r in got] == [
        (0, "B, C", 2001, 'said "x", then')
    ]
    inferred = readers.read_csv_documents(spark, str(path), schema=None)
    assert dict(inferred.dtypes)["docIndex"] == "int" and inferred.count() == 1


def test_csv_documents_are_read_by_column_name(spark, tmp_path):
    path = tmp_path / "docs.csv"
    path.write_text('text,extra,docIndex,Title\n"one\nline",x,7,T\ntwo,y,abc,U\n,z,9,V\n', encoding="utf-8")
    got = readers.read_csv_documents(spark, str(path), multi_line=True)
    assert got.columns == readers.DOCUMENT_SCHEMA.names
    rows = [(r["docIndex"], r["Title"], r["Author"], r["text"]) for r in got.collect()]
    assert rows == [(7, "T", None, "one\nline"), (None, "U", None, "two")]
    named = readers.read_csv_documents(spark, str(path), "docIndex long, text string", multi_line=True)
    assert [tuple(r) for r in named.collect()] == [(7, "one\nline"), (None, "two")]


@pytest.mark.parametrize("schema", [readers.DOCUMENT_SCHEMA, None])
def test_csv_documents_need_a_text_column(spark, tmp_path, schema):
    path = tmp_path / "docs.csv"
    path.write_text("docIndex,body\n1,a\n", encoding="utf-8")
    with pytest.raises(ValueError, match="text"):
        readers.read_csv_documents(spark, str(path), schema)


def test_labelled_csv(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text('"0","1","Mon","q","u","so ""sad"", really"\n"4","2","Tue","q","u","fine"\n', encoding="utf-8")
    got = readers.read_labelled_csv(spark, str(path)).collect()
    assert [tuple(r) for r in got] == [(0.0, 'so "sad", really'), (4.0, "fine")]


def test_lexicon_and_tagged_corpus(spark, tmp_path):
    (tmp_path / "dict.txt").write_text("New York,LOC\nAda,PER\nbroken\n", encoding="utf-8")
    assert sorted(map(tuple, readers.read_lexicon(spark, str(tmp_path / "dict.txt")).collect())) == [
        ("Ada", "PER"), ("New York", "LOC"),
    ]
    (tmp_path / "pos.txt").write_text("The|DT dog|NN runs|VBZ\nplain |X a|b|NN\n", encoding="utf-8")
    assert sorted(map(tuple, readers.read_tagged_corpus(spark, str(tmp_path / "pos.txt")).collect())) == [
        ("The", "DT"), ("a", "NN"), ("dog", "NN"), ("runs", "VBZ"),
    ]


def test_literal_documents(spark):
    assert readers.literal_documents(spark, ["One.", "Two.", "Three."]).count() == 3


def test_small_filters(spark):
    df = spark.createDataFrame(
        [(0, "en", "x #y", "s1"), (1, "de", "x #y", "s2"), (2, "en", "so sad", None), (3, None, None, "s1")],
        "doc_id long, lang string, text string, source string",
    )

    def ids(frame):
        return sorted(r["doc_id"] for r in frame.collect())

    assert ids(filters.with_text(df)) == [0, 1, 2]
    assert ids(filters.with_hashtag(df)) == [0]
    assert ids(filters.with_any_keyword(df)) == [2]
    assert ids(filters.key_not_null(df, "source")) == [0, 1, 3]
    nested = df.withColumn("mongoSetId", filters.object_id(F.col("source")))
    assert ids(filters.in_set(nested, "s1")) == [0, 3]
    found = filters.query_view(nested, "v", "SELECT * FROM v WHERE mongoSetId.oid = :oid", oid="s1' OR '1'='1")
    assert ids(found) == []
    assert ids(filters.status_like(df, "%#y%", "text")) == [0, 1]
    assert filters.renamed(df, {"doc_id": "d"}).columns == ["d"]


def test_stored_tables_belong_to_the_application_and_can_be_cleared(spark, tmp_path, monkeypatch):
    from textloom import session

    monkeypatch.setattr(session, "scratch_dir", lambda _: str(tmp_path))
    table = session.stored(spark.range(3), "numbers")
    assert table.count() == 3
    folder = tmp_path / "textloom" / spark.sparkContext.applicationId
    assert [p.name.split("-")[0] for p in folder.iterdir()] == ["numbers"]
    session.clear_scratch(spark)
    assert not folder.exists()


def test_the_scratch_folder_is_the_one_the_session_names(spark):
    from textloom import session

    assert session.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_small_inputs_are_spread_and_large_ones_left_alone(spark):
    from textloom.session import spread

    assert spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == 8
    assert spread(spark.range(100, numPartitions=6)).rdd.getNumPartitions() == 6


def test_vocabulary_is_not_cut(spark):
    counts = spark.range((1 << 18) + 500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("term"), F.lit(1).alias("n"))
    assert corpus.vocabulary_fit(counts, 1).count() == (1 << 18) + 500


def test_large_lookup_beside_a_map_column(spark):
    rows = spark.createDataFrame([("a", {"x": 1}), ("b", None)], "word string, m map<string,int>")
    lookup = spark.createDataFrame([("a", "n")], "word string, tag string")
    small, large = (joins.lookup_join(rows, lookup, "word", "left", max_bytes=size).collect() for size in (1 << 20, 0))
    assert sorted(small, key=str) == sorted(large, key=str)


def test_cut_words_are_counted_inside_the_row(spark):
    docs = spark.createDataFrame([(1, "Notes noted no"), (2, None), (3, "note _x")], "doc_id long, text string")
    counts = tokens.word_counts(docs, cut=4, ids_unique=True)
    assert {tuple(r) for r in counts.collect()} == {(1, "note", 2), (1, "no", 1), (3, "note", 1), (3, "_x", 1)}
    plan = counts._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "HashAggregate" not in plan


def test_known_counts_spare_counting_the_keys(spark, monkeypatch):
    labels = []
    monkeypatch.setattr(joins, "stored", lambda df, label: labels.append(label) or df)
    rows = spark.createDataFrame([(i, "hot" if i % 2 else f"w{i}") for i in range(50)], "doc_id long, word string")
    lookup = spark.createDataFrame([("hot", "h"), ("w2", "x")], "word string, stem string")
    known = rows.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    got = joins.lookup_join(rows, lookup, "word", "left", max_bytes=0, key_counts=known)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.join(lookup, "word", "left").collect()))
    assert "key-counts" not in labels


def test_analysis_adds_up_its_counts_once(spark, monkeypatch):
    labels = []
    for module in (analyze, corpus, joins):
        keep = module.stored
        monkeypatch.setattr(module, "stored", lambda df, label, keep=keep: labels.append(label) or keep(df, label))
    monkeypatch.setattr(joins, "lookup_bytes", lambda lookup: 1 << 40)
    docs = spark.createDataFrame([(1, "big cats run"), (2, "a big cat ran"), (3, "the")], "doc_id long, text string")
    features, ngrams = analyze.analyze_text(docs, "c1", bigrams=True, min_df=1)
    assert labels.count("key-counts") <= 1 and labels.count("term-stats") == 1
    by_doc = {r["d"]: (r["indexes"], r["counts"]) for r in features.collect()}
    terms = {r["index"]: r["stem"] for r in ngrams.collect()}
    assert {terms[i] for i in by_doc[1][0]} == {"big", "cat", "run", "big cats", "cats run"}
    assert set(by_doc) == {1, 2}


def test_analysis_keeps_no_table_that_is_no_longer_read(spark, texts):
    before = set(os.listdir(job_dir(spark).removeprefix("file:"))) if os.path.isdir(job_dir(spark).removeprefix("file:")) else set()
    features, ngrams = analyze_text(texts, "c9", bigrams=True, min_df=1)
    want = brute(TEXTS, porter2, True, 1)
    assert {r["d"]: (r["indexes"], r["counts"]) for r in features.collect()} == want[0] and ngrams.count() == len(want[1])
    left = {x.split("-")[0] for x in set(os.listdir(job_dir(spark).removeprefix("file:"))) - before}
    assert "counts" in left and "words" not in left


def test_a_vector_pair_moves_as_one_number(spark):
    counts = spark.createDataFrame([(1, "a", (1 << 31) - 1), (1, "b", 1), (2, "c", 3)], "doc_id long, term string, n long")
    vocabulary = spark.createDataFrame([("a", (1 << 31) - 1), ("b", 0)], "term string, index int")
    got = corpus.doc_features(counts, vocabulary, "c").orderBy("d")
    assert [tuple(r) for r in got.collect()] == [(1, [0, (1 << 31) - 1], [1, (1 << 31) - 1], "c"), (2, [], [], "c")]
    assert "struct<index" not in got._jdf.queryExecution().optimizedPlan().treeString()
    assert "shiftleft" in got._jdf.queryExecution().optimizedPlan().toString()
