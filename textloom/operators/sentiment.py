"""Naive Bayes sentiment: the fitted pipeline, and its statistics as plain aggregations."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import stored

# Feature buckets and smoothing.
FEATURE_BUCKETS = 2000
SMOOTHING = 1.0


def hashing_tf(df: DataFrame, words: str, features: str = "features", buckets: int = FEATURE_BUCKETS) -> DataFrame:
    """Add the sparse term-frequency vector of a word array."""
    return HashingTF(numFeatures=buckets, inputCol=words, outputCol=features).transform(df)


def naive_bayes() -> NaiveBayes:
    """The multinomial estimator over ``features`` and ``label``."""
    return NaiveBayes(smoothing=SMOOTHING, modelType="multinomial")


def sentiment_stages(text: str = "status", buckets: int = FEATURE_BUCKETS) -> list:
    """Tokenizer, stop words, hashing, naive Bayes."""
    return [
        Tokenizer(inputCol=text, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered"),
        HashingTF(numFeatures=buckets, inputCol="filtered", outputCol="features"),
        naive_bayes(),
    ]


def class_labels(training: DataFrame) -> list[float]:
    """The classes in ascending order, which is the order of the predicted index."""
    rows = training.where(F.col("label").isNotNull()).groupBy("label").count().select("label")
    return sorted(float(r["label"]) for r in rows.collect())


def fit_sentiment(
    training: DataFrame, text: str = "status", buckets: int = FEATURE_BUCKETS, named: bool = False
) -> PipelineModel:
    """Fit on ``label`` and text. Predictions are class indexes 0, 1, ... in label order.

    ``named`` adds ``predicted_label`` with the label value of the predicted class as text.
    """
    stages = sentiment_stages(text, buckets)
    if named:
        # Of the rows that are fitted on: a label without text is no class.
        labels = [str(v) for v in class_labels(training.where(F.col(text).isNotNull()))]
        stages.append(IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels))
    rows = training.where(F.col("label").isNotNull() & F.col(text).isNotNull())
    return Pipeline(stages=stages).fit(rows.select(F.col("label").cast("double").alias("label"), text))


def score(messages: DataFrame, model: PipelineModel, text: str = "status") -> DataFrame:
    """Messages, batch or stream, with prediction, probability and raw score; null texts are dropped."""
    return model.transform(messages.where(F.col(text).isNotNull()))


def scored_columns(scored: DataFrame) -> DataFrame:
    """``prediction, status, createdAt`` of scored messages, without the model's vectors."""
    return scored.select("prediction", "status", "createdAt")


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline, replacing an older one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def nb_log_prior(labels: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """``label, log_prior`` from one ``label`` row per training document."""
    per_class = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # One row per class: the totals fit in a literal.
    total = per_class.agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("classes")).first()
    docs = (total["docs"] or 0) + total["classes"] * smoothing
    return per_class.select(
        "label", (F.log(F.col("n") + F.lit(smoothing)) - F.log(F.lit(docs))).alias("log_prior")
    )


def nb_log_theta(term_counts: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """``label, term, log_theta`` for each class and vocabulary term.

    ``term_counts`` is ``label, term, n``, one row or more per pair, over the chosen vocabulary.
    Every term gets a row per class, also with no occurrence: the counts of a term are laid out by
    class in one aggregation and unfolded again, so no term table is crossed with the classes.
    """
    per_pair = stored(term_counts.groupBy("label", "term").agg(F.sum("n").alias("n")), "class-terms")
    totals = {r["label"]: r["n"] for r in per_pair.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    labels = sorted(totals)
    by_term = per_pair.groupBy("term").agg(
        *[F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(f"n_{i}") for i, v in enumerate(labels)]
    )
    size = by_term.count()
    rows = F.array(
        *[
            F.struct(
                F.lit(v).alias("label"),
                (
                    F.log(F.col(f"n_{i}") + F.lit(smoothing)) - F.log(F.lit(totals[v] + size * smoothing))
                ).alias("log_theta"),
            )
            for i, v in enumerate(labels)
        ]
    )
    return by_term.select("term", F.explode(rows).alias("c")).select("c.label", "term", "c.log_theta")
