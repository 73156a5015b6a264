"""Train a sentiment model from a labelled file."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from textloom.operators.sentiment import fit_sentiment, save_model
from textloom.sources.readers import read_labelled_csv


def train_sentiment(spark: SparkSession, training_path: str, model_path: str) -> PipelineModel:
    """Fit on a labelled CSV file and save the model, replacing an older one."""
    model = fit_sentiment(read_labelled_csv(spark, training_path))
    save_model(model, model_path)
    return model
