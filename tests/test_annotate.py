import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.functions.annotations import ANNOTATION_TYPE
from textloom.operators import annotate as an
from textloom.plans import tagging
from textloom.sources.readers import literal_documents

TEXT = "Ada Smith met Bob.  She lives in New York City! Really?No end"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(0, TEXT), (1, ""), (2, None), (3, " \n ")], "doc_id long, text string")


@pytest.fixture(scope="module")
def lexicon(spark):
    rows = [
        ("Ada Smith", "PER"), ("Bob", "PER"), ("New York", "LOC"), ("new york city", "LOC"), ("york", "ORG"),
        ("City", "ORG"), ("City", "AAA"), ("", "X"),
    ]
    return spark.createDataFrame(rows, "term string, tag string")


def test_annotation_columns(docs):
    out = an.annotate(docs)
    assert out.columns == ["doc_id", "text", "document", "sentence", "token"]
    for column in ["document", "sentence", "token"]:
        assert dict(out.dtypes)[column] == ANNOTATION_TYPE
    row = out.where("doc_id = 0").first()
    assert [a["result"] for a in row["sentence"]] == [
        "Ada Smith met Bob.", "She lives in New York City!", "Really?No end",
    ]
    for column in ["document", "sentence", "token"]:
        for a in row[column]:
            assert TEXT[a["begin"] : a["end"] + 1] == a["result"] and a["annotatorType"] == column
    assert [a["result"] for a in row["token"]] == re.findall(r"\w+|[^\w\s]", TEXT)
    assert [a["metadata"]["sentence"] for a in row["sentence"]] == ["0", "1", "2"]
    assert row["token"][-1]["metadata"] == {"sentence": "2"}
    empty = out.where("doc_id IN (1, 3)").select("sentence", "token").collect()
    assert all(not r["sentence"] and not r["token"] for r in empty)


def test_annotations_of_the_sample_sentences(spark):
    counts = an.annotate(literal_documents(spark, ["Rain fell on the dry road.", "A dog's bark woke me.", "Tea is hot.  I drank it."])).select(F.size("sentence"), F.size("token")).collect()
    assert [tuple(r) for r in counts] == [(1, 7), (1, 8), (2, 8)]


def test_token_rows_follow_the_annotations(docs):
    rows = an.token_rows(docs).orderBy("sentence", "token").collect()
    assert [r["word"] for r in rows] == re.findall(r"\w+|[^\w\s]", TEXT)
    assert [(r["sentence"], r["token"]) for r in rows][:6] == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0)]
    assert Counter(r["word"] for r in an.token_words(docs).collect()) == Counter(r["word"] for r in rows)


def test_entities_take_the_longest_phrase(docs, lexicon):
    labelled = an.tag_entities(docs, lexicon).orderBy("sentence", "token").collect()
    assert {r["word"]: r["ner"] for r in labelled if r["ner"] != "O"} == {
        "Ada": "PER", "Smith": "PER", "Bob": "PER", "New": "LOC", "York": "LOC", "City": "LOC",
    }
    assert len(labelled) == an.token_rows(docs).count()
    direct = an.entity_token_rows(docs, lexicon)
    same = an.entity_tokens(an.tag_entities(docs, lexicon)).select(direct.columns)
    assert direct.exceptAll(same).isEmpty() and same.exceptAll(direct).isEmpty()


def test_no_lexicon_finds_nothing(docs, lexicon):
    assert an.entity_token_rows(docs, lexicon.where("false")).isEmpty()
    assert an.tag_entities(docs, lexicon.where("false")).where("ner <> 'O'").isEmpty()


def test_neighbours_of_one_label_join(spark):
    rows = [
        (0, 0, 0, "Ada", "PER"), (0, 0, 1, "Smith", "PER"), (0, 0, 2, "of", "O"), (0, 0, 3, "Rome", "LOC"),
        (0, 0, 4, "Bob", "PER"), (0, 0, 6, "Cy", "PER"), (0, 1, 7, "Dee", "PER"),
    ]
    tokens = spark.createDataFrame(rows, "doc_id long, sentence int, token int, word string, ner string")
    got = sorted((r["first"], r["last"], r["entity"], r["ner"]) for r in an.merge_entity_spans(tokens).collect())
    assert got == [(0, 1, "Ada Smith", "PER"), (3, 3, "Rome", "LOC"), (4, 4, "Bob", "PER"), (6, 6, "Cy", "PER"), (7, 7, "Dee", "PER")]


def test_entity_counts_come_most_frequent_first(spark, lexicon):
    docs = spark.createDataFrame([(0, "Bob. Bob. Ada Smith"), (1, "bob")], "doc_id long, text string")
    got = [tuple(r) for r in tagging.count_entities(docs, lexicon).collect()]
    assert got == [("Bob", "PER", 2), ("Ada Smith", "PER", 1), ("bob", "PER", 1)]


def test_lexicon_keeps_the_most_frequent_tag(spark):
    rows = [("Run", "VB"), ("run", "VB"), ("run", "NN"), ("tie", "NN"), ("tie", "JJ")]
    fitted = an.fit_pos_lexicon(spark.createDataFrame(rows, "word string, pos string"))
    assert {r["word"]: r["pos"] for r in fitted.collect()} == {"run": "VB", "tie": "JJ"}


def test_words_outside_the_lexicon_are_tagged_by_shape(spark):
    words = ["Run", "walking", "walked", "quickly", "useful", "dogs", "glass", "12", "!", "zebra"]
    tokens = spark.createDataFrame([(w,) for w in words], "word string")
    lexicon = spark.createDataFrame([("run", "VB")], "word string, pos string")
    got = {r["word"]: r["pos"] for r in an.tag_pos(tokens, lexicon).collect()}
    assert got == {
        "Run": "VB", "walking": "VBG", "walked": "VBD", "quickly": "RB", "useful": "JJ", "dogs": "NNS",
        "glass": "NN", "12": "CD", "!": "SYM", "zebra": "NN",
    }


def test_coarse_tags(spark):
    tags = ["VBD", "NNP", "RB", "RBR", "JJ", "R", "DT"]
    rows = spark.createDataFrame([(t,) for t in tags], "pos string")
    got = {r["pos"]: r["c"] for r in rows.select("pos", an.coarse_pos(F.col("pos")).alias("c")).collect()}
    assert got == {
        "VBD": "VERB", "NNP": "NOUN", "RB": "ADVERB", "RBR": "ADVERB", "JJ": "ADJECTIVE", "R": "R", "DT": "DT",
    }
    assert sorted(r["pos"] for r in an.counted_pos(rows).collect()) == ["JJ", "NNP", "RB", "RBR", "VBD"]


def test_top_words_of_one_tag(spark):
    docs = spark.createDataFrame(
        [(0, "walked walked talked the talked sang dog"), (1, "walked jumping")], "doc_id long, text string"
    )
    lexicon = spark.createDataFrame([("the", "DT"), ("sang", "VBD")], "word string, pos string")
    got = [(r["word"], r["count"]) for r in tagging.top_words(docs, lexicon, "VERB", 3).collect()]
    assert got == [("walked", 3), ("talked", 2), ("jumping", 1)]


def test_sentences_meet_their_labels_before_they_are_split(spark):
    docs = spark.createDataFrame([(1, "New York is big. No."), (1, "Old town is big."), (2, None)], "doc_id long, text string")
    lexicon = spark.createDataFrame([("new york", "PLACE")], "term string, tag string")
    labelled = an.tag_entities(docs, lexicon)
    plan = labelled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("Join LeftOuter")
    got = sorted(tuple(r)[3:] for r in labelled.collect())
    assert got == sorted(
        [("New", "PLACE"), ("York", "PLACE"), ("is", "O"), ("big", "O"), (".", "O"), ("No", "O"), (".", "O")]
        + [(w, "O") for w in ("Old", "town", "is", "big", ".")]
    )
