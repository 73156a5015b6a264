import re
import time
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from textloom.functions import annotations as an
from textloom.functions import text as tx
from textloom.operators import tokens

ODD_TEXTS = [
    "The cold  water", "", " ", "  lead and trail  ", "don't stop", "Été à la plage", "one", "a\tb\nc\n", "\n\n",
    "X_1 y-2  z!", "É", "a b a b a", "#tag y#d # #b#c", "日本 text", "I’m “quoted” naïve", None,
]
relaxed = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")


def values(df, column):
    return df.select("doc_id", F.expr(column) if isinstance(column, str) else column.alias("v")).orderBy("doc_id")


def test_tokenize_regex_equals_the_ml_tokenizer(odd):
    whole = odd.where("text IS NOT NULL")
    want = RegexTokenizer(pattern="\\W", inputCol="text", outputCol="v").transform(whole).select("doc_id", "v")
    got = values(whole, tx.tokenize_regex(F.col("text")))
    assert got.collect() == want.orderBy("doc_id").collect()


def test_tokenize_regex_minimum_length(odd):
    got = {r["doc_id"]: r["v"] for r in values(odd, tx.tokenize_regex(F.col("text"), min_length=2)).collect()}
    assert got[4] == ["don", "stop"] and got[5] == ["la", "plage"] and got[15] is None


def test_tokenize_whitespace_equals_the_ml_tokenizer(odd):
    whole = odd.where("text IS NOT NULL")
    want = Tokenizer(inputCol="text", outputCol="v").transform(whole).select("doc_id", "v")
    got = values(whole, tx.tokenize_whitespace(F.col("text")))
    assert got.collect() == want.orderBy("doc_id").collect()


@pytest.mark.parametrize("case_sensitive", [True, False])
def test_remove_stopwords_equals_the_ml_remover(spark, case_sensitive):
    stops = ["The", "of", "a"]
    df = spark.createDataFrame([(0, ["the", "The", "OF", "x", "a", ""]), (1, [])], "doc_id long, w array<string>")
    remover = StopWordsRemover(inputCol="w", outputCol="v", stopWords=stops, caseSensitive=case_sensitive)
    want = remover.transform(df).select("doc_id", "v").orderBy("doc_id").collect()
    assert values(df, tx.remove_stopwords(F.col("w"), stops, case_sensitive)).collect() == want


def test_no_stop_words_keeps_everything(spark):
    df = spark.createDataFrame([(0, ["a"])], "doc_id long, w array<string>")
    assert values(df, tx.remove_stopwords(F.col("w"), [])).first()["v"] == ["a"]


def test_stop_lists(spark):
    from contract.oracle import STOP_WORDS

    assert sorted(tx.default_stop_words("english")) == sorted(STOP_WORDS)
    assert "nicht" in tx.default_stop_words("german")
    with pytest.raises(Exception, match="language"):
        tx.default_stop_words("klingon")


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams_equal_the_ml_ngrams(spark, n):
    rows = [(0, ["a", "b", "c", "d"]), (1, ["a", "b"]), (2, ["a"]), (3, [])]
    df = spark.createDataFrame(rows, "doc_id long, w array<string>")
    want = NGram(n=n, inputCol="w", outputCol="v").transform(df).select("doc_id", "v").orderBy("doc_id").collect()
    assert values(df, tx.ngrams(F.col("w"), n)).collect() == want


def test_hashtags(spark):
    rows = [(0, "#a b #c #b#c y#d # #A"), (1, "x\n#no"), (2, ""), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, s string")
    got = [r["v"] for r in values(df, tx.extract_hashtags(F.col("s"))).collect()]
    assert got == [["#a", "#c", "#b#c", "#", "#A"], [], [], None]


def test_keywords_match_inside_words_unless_asked(spark):
    df = spark.createDataFrame([(0, "a crusade"), (1, "sad day"), (2, "Sad"), (3, "x")], "doc_id long, s string")
    inside = [r["v"] for r in values(df, tx.contains_any(F.col("s"), ["sad", "bad"])).collect()]
    whole = [r["v"] for r in values(df, tx.contains_any(F.col("s"), ["sad", "bad"], whole_words=True)).collect()]
    assert inside == [True, True, False, False]
    assert whole == [False, True, False, False]
    assert not any(r["v"] for r in values(df, tx.contains_any(F.col("s"), [])).collect())


words = st.lists(st.text("ab_1", min_size=1, max_size=3), max_size=40)


@relaxed
@given(st.lists(words, min_size=1, max_size=20))
def test_runs_count_like_a_counter(spark, arrays):
    df = spark.createDataFrame(list(enumerate(arrays)), "doc_id long, w array<string>")
    runs = df.select("doc_id", F.explode(tx.runs_of_equal(F.col("w"))).alias("run"))
    got = runs.select("doc_id", tx.run_word(F.col("run")), tx.run_length(F.col("run"))).collect()
    want = [(i, w, n) for i, a in enumerate(arrays) for w, n in Counter(a).items()]
    assert sorted(map(tuple, got)) == sorted(want)


def test_runs_of_a_long_repetition(spark):
    df = spark.range(1).select(F.array_repeat(F.lit("word"), 300_000).alias("w"))
    run = df.select(F.explode(tx.runs_of_equal(F.col("w"))).alias("run"))
    assert run.select(tx.run_word(F.col("run")), tx.run_length(F.col("run"))).collect() == [("word", 300_000)]


def test_word_counts_with_unique_and_repeated_ids(spark, odd):
    want = Counter(
        (r["doc_id"], w)
        for r in odd.collect()
        for w in re.findall(r"(?a)\w+", (r["text"] or "").lower())
    )
    got = {(r["doc_id"], r["word"]): r["n"] for r in tokens.word_counts(odd).collect()}
    assert got == dict(want)
    doubled = odd.unionByName(odd)
    assert tokens.unique_ids(odd) and not tokens.unique_ids(doubled)
    got = {(r["doc_id"], r["word"]): r["n"] for r in tokens.word_counts(doubled).collect()}
    assert got == {k: 2 * n for k, n in want.items()}


def test_word_counts_of_unique_ids_move_nothing(odd):
    plan = tokens.word_counts(odd, ["the"], ids_unique=True)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


@relaxed
@given(st.lists(st.lists(st.integers(0, 9), max_size=70), min_size=1, max_size=10))
def test_running_total(spark, arrays):
    df = spark.createDataFrame(list(enumerate(arrays)), "doc_id long, a array<int>")
    got = [r["v"] for r in values(df, an.running_total(F.col("a"))).collect()]
    assert got == [[sum(a[: i + 1]) for i in range(len(a))] for a in arrays]


@relaxed
@given(st.lists(st.text("aé.! \n'1日", max_size=40), min_size=1, max_size=10))
def test_spans_equal_a_scan_of_the_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = values(df, an.spans(F.col("text"), an.TOKEN)).collect()
    for row, text in zip(got, texts):
        want = [(m.start(), m.end() - 1, m.group()) for m in re.finditer(r"(?a)\w+|[^\w\s]", text)]
        assert [tuple(s) for s in row["v"]] == want
    got = values(df, an.spans(F.col("text"), an.SENTENCE)).collect()
    for row, text in zip(got, texts):
        pattern = r"(?as)(?=\S).*?(?:[.!?](?=\s)|(?=\s*\Z))"
        assert [tuple(s) for s in row["v"]] == [
            (m.start(), m.end() - 1, m.group()) for m in re.finditer(pattern, text)
        ]


def test_sentences_of_blanks_and_of_many_words(spark):
    texts = ["a" + " " * 200_000 + "b", "word " * 20_000, "a. " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    started = time.perf_counter()
    got = values(df, F.transform(an.spans(F.col("text"), an.SENTENCE), lambda s: s["end"])).collect()
    assert time.perf_counter() - started < 10
    assert [len(r["v"]) for r in got] == [1, 1, 20_000]
    assert [r["v"][0] for r in got] == [200_001, 99_998, 1]
