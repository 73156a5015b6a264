"""Hashtag trends over sliding event-time windows; the same code runs on tables and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import extract_hashtags

# Window size, slide and accepted lateness.
WINDOW = "10 minutes"
SLIDE = "5 minutes"
LATENESS = "10 minutes"


def hashtag_rows(records: DataFrame) -> DataFrame:
    """``hashtag, prediction, timestamp`` row per hashtag of a scored message."""
    return records.select(
        F.explode(extract_hashtags(F.col("status"))).alias("hashtag"),
        "prediction",
        F.col("createdAt").alias("timestamp"),
    )


def windowed_trend(
    tags: DataFrame, size: str = WINDOW, slide: str = SLIDE, lateness: str | None = None
) -> DataFrame:
    """``window, hashtag, count, avg``: uses and mean prediction per window and hashtag.

    Counts and sums are combined before the shuffle, so a hashtag in a third of all messages costs
    one partial row per task and window. ``lateness`` sets the watermark of a stream.
    """
    if lateness is not None:
        tags = tags.withWatermark("timestamp", lateness)
    return tags.groupBy(F.window("timestamp", size, slide), "hashtag").agg(
        F.count("hashtag").alias("count"), F.avg("prediction").alias("avg")
    )


def window_bounds(trend: DataFrame) -> DataFrame:
    """The window struct as two columns beside key and measures."""
    return trend.select("window.start", "window.end", "hashtag", "count", "avg")


def sorted_trend(trend: DataFrame) -> DataFrame:
    """Windows in time order, most used hashtags first, ties by name."""
    return trend.orderBy(F.asc("window"), F.desc("count"), F.asc("hashtag"))
