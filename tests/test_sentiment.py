import math

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from textloom.operators import sentiment as se
from textloom.plans.train import train_sentiment

ROWS = [
    (0.0, "awful terrible sad day"), (0.0, "terrible hate"), (0.0, "sad awful"),
    (4.0, "lovely happy day"), (4.0, "happy happy love"), (4.0, "lovely sunshine"), (4.0, "love"),
]


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame([*ROWS, (None, "no label"), (0.0, None)], "label double, status string")


def test_predictions_are_class_indexes_and_can_be_named(spark, training):
    model = se.fit_sentiment(training, named=True)
    rows = spark.createDataFrame([("what a terrible day",), ("Happy LOVE",), (None,)], "status string")
    scored = se.score(rows, model)
    assert [(r["prediction"], r["predicted_label"]) for r in scored.collect()] == [(0.0, "0.0"), (1.0, "4.0")]
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in scored.collect())
    assert se.class_labels(training) == [0.0, 4.0]


def test_saved_model_predicts_the_same(spark, training, tmp_path):
    model, path = se.fit_sentiment(training), str(tmp_path / "model")
    se.save_model(model, path)
    se.save_model(model, path)
    rows = training.select("status")
    want = [r["prediction"] for r in se.score(rows, model).collect()]
    assert [r["prediction"] for r in se.score(rows, se.load_model(path)).collect()] == want


def test_training_from_a_file(spark, tmp_path):
    lines = [f'"{int(label)}","1","d","q","u","{status}"' for label, status in ROWS]
    (tmp_path / "train.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    train_sentiment(spark, str(tmp_path / "train.csv"), str(tmp_path / "model"))
    rows = spark.createDataFrame([("sad awful",), ("lovely",)], "status string")
    scored = se.score(rows, se.load_model(str(tmp_path / "model")))
    assert [r["prediction"] for r in scored.collect()] == [0.0, 1.0]


def test_statistics_equal_the_fitted_model(spark, training):
    rows = training.where("label IS NOT NULL AND status IS NOT NULL").withColumn("w", F.split("status", " "))
    vectorizer = CountVectorizer(inputCol="w", outputCol="features").fit(rows)
    model = NaiveBayes(smoothing=1.0).fit(vectorizer.transform(rows).withColumn("label", (F.col("label") / 4)))
    counts = rows.select("label", F.explode("w").alias("term")).withColumn("n", F.lit(1))
    theta = {(r["label"], r["term"]): r["log_theta"] for r in se.nb_log_theta(counts).collect()}
    matrix = model.theta.toArray()
    assert len(theta) == 2 * len(vectorizer.vocabulary)
    for i, term in enumerate(vectorizer.vocabulary):
        for k, label in enumerate([0.0, 4.0]):
            assert math.isclose(theta[label, term], matrix[k][i], rel_tol=1e-12)
    prior = {r["label"]: r["log_prior"] for r in se.nb_log_prior(rows.select("label")).collect()}
    assert [prior[0.0], prior[4.0]] == pytest.approx(list(model.pi.toArray()))


def test_hashing_keeps_every_word(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), ([],)], "w array<string>")
    vectors = [r["features"] for r in se.hashing_tf(df, "w").collect()]
    assert [v.size for v in vectors] == [2000, 2000] and [v.values.sum() for v in vectors] == [3.0, 0.0]


def test_labels_of_null_texts_name_no_class(spark):
    rows = [(0.0, None), (4.0, "good fine"), (8.0, "bad sad"), (4.0, "good"), (8.0, "bad")]
    training = spark.createDataFrame(rows, "label double, status string")
    model = se.fit_sentiment(training, named=True)
    named = {r["status"]: r["predicted_label"] for r in se.score(training, model).collect()}
    assert named["good"] == "4.0" and named["bad"] == "8.0"
