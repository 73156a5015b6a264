"""Running streams: scoring and publishing, trends, and filters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from textloom.functions.messages import scored_csv, scored_text
from textloom.operators.filters import having_min_count, query_view, with_any_keyword, with_hashtag
from textloom.operators.sentiment import score
from textloom.operators.trends import LATENESS, hashtag_rows, sorted_trend, window_bounds, windowed_trend

# Batch interval and rows shown on the console.
BATCH_INTERVAL = "5 seconds"
CONSOLE_ROWS = 100
# State of many hashtags lives on disk beside the executor instead of in its heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, for key spaces larger than executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


# --- what is computed --------------------------------------------------------------------------


def as_status(messages: DataFrame) -> DataFrame:
    """``status, createdAt`` of live messages."""
    return messages.select(F.col("text").alias("status"), "createdAt")


def hashtag_lines(messages: DataFrame, model: PipelineModel) -> DataFrame:
    """Scored messages with a hashtag, as CSV lines in ``value``."""
    scored = score(as_status(with_hashtag(messages)), model)
    return scored.select(scored_csv(F.col("prediction"), F.col("status"), F.col("createdAt")).alias("value"))


def sentiment_lines(messages: DataFrame, model: PipelineModel) -> DataFrame:
    """Scored messages with a sentiment keyword, as text lines in ``value``."""
    scored = score(as_status(with_any_keyword(messages)), model)
    return scored.select(scored_text(F.col("prediction"), F.col("status")).alias("value"))


def popular_trends(records: DataFrame, more_than: int = 3, lateness: str | None = LATENESS) -> DataFrame:
    """Window bounds, hashtag, count and mean prediction of often used hashtags."""
    return having_min_count(windowed_trend(hashtag_rows(records), lateness=lateness), more_than)


# --- where it goes -----------------------------------------------------------------------------


def queue_sink(
    lines: DataFrame, servers: str, topic: str, checkpoint: str, options: Mapping[str, str] | None = None
) -> DataStreamWriter:
    """Publish ``value`` lines to a topic; needs the queue's connector on the classpath."""
    base = {"kafka.bootstrap.servers": servers, "topic": topic}
    writer = lines.select("value").writeStream.format("kafka").options(**{**base, **(options or {})})
    return writer.option("checkpointLocation", checkpoint).outputMode("append")


def file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """Append finished rows to a folder."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append")


def console_sink(
    df: DataFrame, checkpoint: str, mode: str, rows: int = CONSOLE_ROWS, truncate: bool = True
) -> DataStreamWriter:
    """Show each batch on the console."""
    writer = df.writeStream.format("console").option("numRows", rows).option("truncate", truncate)
    return writer.option("checkpointLocation", checkpoint).outputMode(mode)


def every_interval(writer: DataStreamWriter, interval: str = BATCH_INTERVAL) -> DataStreamWriter:
    """Run one batch per interval."""
    return writer.trigger(processingTime=interval)


def publish_batches(df: DataFrame, path: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> DataStreamWriter:
    """Publish each batch to a folder named by its id.

    A batch that runs again after a restart, or from an older checkpoint, has the same id and replaces its folder,
    so every message is published once. In complete mode the greatest id holds the whole result.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return df.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).outputMode(mode)


def published(spark: SparkSession, path: str, schema: StructType, latest: bool = False, fmt: str = "parquet") -> DataFrame:
    """Rows of all published batches, or of the latest one only."""
    whole = StructType([*schema.fields, StructField("batch_id", LongType())])
    rows = spark.read.schema(whole).format(fmt).load(path)
    if latest:
        rows = rows.where(F.col("batch_id") == (rows.agg(F.max("batch_id")).first()[0] or 0))
    return rows.drop("batch_id")


def run_together(writers: Mapping[str, DataStreamWriter]) -> dict[str, str | None]:
    """Run named queries at once until their sources are used up; the error of each, or None.

    Each query has its own checkpoint. One that fails is reported and does not end the others.
    """
    running = {name: writer.queryName(name).trigger(availableNow=True).start() for name, writer in writers.items()}
    ended: dict[str, str | None] = {}
    for name, query in running.items():
        try:
            query.awaitTermination()
            ended[name] = None
        except StreamingQueryException as error:
            ended[name] = str(error)
    return ended


def replay(batches: Sequence[DataFrame], make: Callable[[DataFrame], DataStreamWriter], folder: str) -> None:
    """Feed tables of one schema to a stream, one after the other, each in a run that continues the last.

    ``make`` turns the stream of the folder into a writer with a checkpoint.
    """
    for batch in batches:
        batch.write.mode("append").parquet(folder)
        until_drained(make(batch.sparkSession.readStream.schema(batch.schema).parquet(folder)))


def until_drained(writer: DataStreamWriter) -> None:
    """Process everything the source holds now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


# --- whole streams -----------------------------------------------------------------------------


def start_hashtag_scoring(
    messages: DataFrame, model: PipelineModel, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Score messages with hashtags and publish them as CSV lines."""
    return every_interval(queue_sink(hashtag_lines(messages, model), servers, topic, checkpoint)).start()


def start_sentiment_scoring(
    messages: DataFrame, model: PipelineModel, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Score messages with sentiment keywords and publish them as text lines."""
    return every_interval(queue_sink(sentiment_lines(messages, model), servers, topic, checkpoint)).start()


def trend_report(records: DataFrame) -> DataFrame:
    """Popular trends in report order; as a stream it runs in complete mode only."""
    return window_bounds(sorted_trend(popular_trends(records)))


def status_report(records: DataFrame, pattern: str, view: str = "records") -> DataFrame:
    """Records whose status is like a pattern, by SQL over a view of the stream."""
    return query_view(records, view, f"SELECT * FROM {view} WHERE status LIKE :pattern", pattern=pattern)


def start_reports(records: DataFrame, checkpoint: str, pattern: str) -> list[StreamingQuery]:
    """The trend report and the status report on the console, side by side."""
    return [
        console_sink(trend_report(records), f"{checkpoint}/trends", "complete").start(),
        console_sink(status_report(records, pattern), f"{checkpoint}/status", "append", truncate=False).start(),
    ]


def await_reports(spark: SparkSession) -> None:
    """Wait until any running stream ends or fails."""
    spark.streams.awaitAnyTermination()
