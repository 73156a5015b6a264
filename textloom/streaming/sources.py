"""Streaming sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.messages import SCORED_FIELDS, parse_scored_csv

MESSAGE_SCHEMA = "lang string, text string, createdAt timestamp"


def queue_options(servers: str, topic: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options of a message queue, from its first message."""
    base = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    return {**base, **(options or {})}


def cast_value(messages: DataFrame) -> DataFrame:
    """The message body as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def queue_source(
    spark: SparkSession, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Text messages of a topic; needs the queue's connector on the classpath."""
    reader = spark.readStream.format("kafka").options(**queue_options(servers, topic, options))
    return cast_value(reader.load())


def file_source(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", options: Mapping[str, str] | None = None
) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).format(fmt).options(**(options or {})).load(path)


def message_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema: str = MESSAGE_SCHEMA,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Live messages ``lang, text, createdAt`` that another service drops into a folder."""
    return file_source(spark, path, schema, fmt, options)


def messages_from_queue(lines: DataFrame, schema: str = MESSAGE_SCHEMA) -> DataFrame:
    """Live messages ``lang, text, createdAt`` that arrive as JSON text on a queue."""
    return lines.select(F.from_json("value", schema).alias("m")).select("m.*")


def scored_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed scored messages, and apart the lines with a missing or malformed field."""
    parsed = lines.select("value", parse_scored_csv(F.col("value")).alias("r"))
    good = F.lit(True)
    for field in SCORED_FIELDS:
        good = good & F.col(f"r.{field}").isNotNull()
    return parsed.where(good).select("r.*"), parsed.where(~good).select("value")
