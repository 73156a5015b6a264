"""Batch sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from textloom.operators.filters import key_not_null, object_id

# Collections the results go to.
NGRAM_COLLECTION = "NGram"
FEATURE_COLLECTION = "WordDocCount"


def save_collection(
    df: DataFrame, fmt: str, collection: str, base: str | None = None, options: Mapping[str, str] | None = None
) -> None:
    """Append to a collection: a folder under ``base``, or the ``collection`` option of a connector."""
    writer = df.write.format(fmt).mode("append").options(**(options or {}))
    if base is not None:
        writer.save(f"{base.rstrip('/')}/{collection}")
    else:
        writer.option("collection", collection).save()


def ngrams_with_id(ngrams: DataFrame, classifier_id: str | None) -> DataFrame:
    """N-gram rows with their classifier's id as a struct, only where the id is not null."""
    return key_not_null(ngrams.withColumn("classifierId", object_id(classifier_id)), "classifierId.oid")


def save_ngrams(
    ngrams: DataFrame,
    classifier_id: str | None,
    fmt: str,
    base: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    save_collection(ngrams_with_id(ngrams, classifier_id), fmt, NGRAM_COLLECTION, base, options)


def save_doc_features(
    features: DataFrame, fmt: str, base: str | None = None, options: Mapping[str, str] | None = None
) -> None:
    """Feature rows, only where the classifier id is not null."""
    save_collection(key_not_null(features, "cId"), fmt, FEATURE_COLLECTION, base, options)
