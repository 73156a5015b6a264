import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from textloom.functions import messages as msg
from textloom.operators import sentiment, trends
from textloom.operators.filters import having_min_count
from textloom.streaming import queries, sources

START = dt.datetime(2024, 1, 1, 12, 0)
RECORD = "prediction double, status string, createdAt timestamp"


def at(minute: float) -> dt.datetime:
    return START + dt.timedelta(minutes=minute)


def drop_lines(folder, name, rows):
    """Scored messages as one file of CSV lines, as a queue would hold them."""
    folder.mkdir(exist_ok=True)
    lines = [f'"{p}","{s}","{t}.0"' for p, s, t in rows]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def record_stream(spark, folder, **options):
    lines = sources.file_source(spark, str(folder), "value string", "text", options)
    return sources.scored_records(lines)[0]


def run_to_memory(df, name, mode, checkpoint):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.table(name)


ROWS = [(1.0, "hi #a #b", at(m)) for m in (1, 2, 3, 4, 6)] + [(0.0, "#a urgent", at(7)), (0.0, "none", at(8))]


def test_windows_hold_both_slides(spark):
    tags = trends.hashtag_rows(spark.createDataFrame(ROWS, RECORD))
    got = trends.window_bounds(trends.sorted_trend(trends.windowed_trend(tags))).collect()
    assert [(r["start"], r["end"], r["hashtag"], r["count"], round(r["avg"], 6)) for r in got] == [
        (at(-5), at(5), "#a", 4, 1.0), (at(-5), at(5), "#b", 4, 1.0),
        (at(0), at(10), "#a", 6, round(5 / 6, 6)), (at(0), at(10), "#b", 5, 1.0),
        (at(5), at(15), "#a", 2, 0.5), (at(5), at(15), "#b", 1, 1.0),
    ]
    popular = having_min_count(trends.windowed_trend(tags), 4).collect()
    assert sorted((r["hashtag"], r["count"]) for r in popular) == [("#a", 6), ("#b", 5)]


def test_the_stream_equals_the_table(spark, tmp_path):
    drop_lines(tmp_path / "in", "1.txt", ROWS[:3])
    drop_lines(tmp_path / "in", "2.txt", ROWS[3:])
    records = record_stream(spark, tmp_path / "in", maxFilesPerTrigger="1")
    got = run_to_memory(queries.trend_report(records), "trend_all", "complete", tmp_path / "cp").collect()
    want = queries.trend_report(spark.createDataFrame(ROWS, RECORD)).collect()
    assert got == want and len(got) == 4


def in_batches(spark, tmp_path, name, mode, batches):
    """Run the trend over batches of rows, one after the other, and return the last table."""
    (tmp_path / "in").mkdir()
    records = record_stream(spark, tmp_path / "in")
    trend = trends.window_bounds(queries.popular_trends(records, 0))
    for i, rows in enumerate(batches):
        drop_lines(tmp_path / "in", f"{i}.txt", rows)
        query = (
            trend.writeStream.format("parquet" if mode == "append" else "memory").queryName(f"{name}{i}")
            .outputMode(mode).option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    if mode == "append":
        return spark.read.parquet(str(tmp_path / "out"))
    return spark.table(f"{name}{len(batches) - 1}")


LATE = [[(1.0, "#a", at(1))], [(1.0, "#a", at(120))], [(1.0, "#a", at(121))], [(1.0, "#a", at(2))], [(1.0, "#a", at(240))]]


def test_late_rows_count_in_complete_mode(spark, tmp_path):
    got = in_batches(spark, tmp_path, "late_complete", "complete", LATE)
    assert got.where(F.col("start") == at(0)).first()["count"] == 2


def test_late_rows_are_dropped_in_append_mode(spark, tmp_path):
    got = in_batches(spark, tmp_path, "late_append", "append", LATE)
    assert [r["count"] for r in got.where(F.col("start") == at(0)).collect()] == [1]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(0.0, "sad bad hate"), (0.0, "bad #x day"), (4.0, "happy good love"), (4.0, "good #y sun")]
    return sentiment.fit_sentiment(spark.createDataFrame(rows, "label double, status string"))


MESSAGES = [
    {"lang": "en", "text": "happy #sun, \"good\"", "createdAt": "2024-01-01T12:00:00Z"},
    {"lang": "en", "text": "bad crusade", "createdAt": "2024-01-01T12:00:01.500Z"},
    {"lang": "de", "text": "bad #tag", "createdAt": "2024-01-01T12:00:02Z"},
    {"lang": "en", "text": "plain", "createdAt": "2024-01-01T12:00:03Z"},
    {"text": "sad #nolang", "createdAt": "2024-01-01T12:00:04Z"},
]


def message_folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.json").write_text("\n".join(map(json.dumps, MESSAGES)), encoding="utf-8")
    return sources.message_stream, str(tmp_path / "in")


def test_hashtag_messages_are_scored_and_published_as_csv(spark, model, tmp_path):
    read, folder = message_folder(tmp_path)
    lines = queries.hashtag_lines(read(spark, folder), model)
    queries.until_drained(queries.file_sink(lines, str(tmp_path / "out"), str(tmp_path / "cp"), "text"))
    got = [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert got == ['"1.0","happy #sun, ""good""","2024-01-01 12:00:00.0"']
    parsed = spark.read.text(str(tmp_path / "out")).select(msg.parse_scored_csv(F.col("value")).alias("r"))
    assert tuple(parsed.first()["r"]) == (1.0, 'happy #sun, "good"', START)


def test_keyword_messages_are_scored_and_published_as_text(spark, model, tmp_path):
    read, folder = message_folder(tmp_path)
    lines = queries.sentiment_lines(read(spark, folder), model)
    queries.until_drained(queries.file_sink(lines, str(tmp_path / "out"), str(tmp_path / "cp"), "text"))
    got = sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == ["0.0 -- bad crusade", '1.0 -- happy #sun, "good"']


def test_stream_and_table_score_alike(spark, model, tmp_path):
    read, folder = message_folder(tmp_path)
    status = queries.as_status(read(spark, folder))
    scored = sentiment.scored_columns(sentiment.score(status, model))
    got = run_to_memory(scored, "scored_all", "append", tmp_path / "cp").collect()
    table = spark.createDataFrame(got).select("status", "createdAt")
    assert len(got) == 5
    assert [r["prediction"] for r in sentiment.score(table, model).collect()] == [r["prediction"] for r in got]


def test_messages_can_come_as_json_from_a_queue(spark):
    lines = spark.createDataFrame([(json.dumps(m).encode(),) for m in MESSAGES], "value binary")
    got = sources.messages_from_queue(sources.cast_value(lines)).collect()
    assert [(r["lang"], r["text"]) for r in got] == [(m.get("lang"), m["text"]) for m in MESSAGES]


def test_both_reports_run_side_by_side(spark, tmp_path):
    drop_lines(tmp_path / "in", "1.txt", ROWS)
    running = queries.start_reports(record_stream(spark, tmp_path / "in"), str(tmp_path / "cp"), "%urgent%")
    try:
        assert len(spark.streams.active) == 2
        for query in running:
            query.processAllAvailable()
            assert query.recentProgress[0].numInputRows == len(ROWS)
            assert "Console" in query.recentProgress[0].sink.description
    finally:
        for query in running:
            query.stop()
    queries.await_reports(spark)


def test_the_status_report_filters_by_sql(spark, tmp_path):
    drop_lines(tmp_path / "in", "1.txt", ROWS)
    report = queries.status_report(record_stream(spark, tmp_path / "in"), "%urgent%")
    got = run_to_memory(report, "status_all", "append", tmp_path / "cp").collect()
    assert [r["status"] for r in got] == ["#a urgent"]


def test_queue_options():
    got = sources.queue_options("h:1", "topic", {"maxOffsetsPerTrigger": "10"})
    assert got == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "topic", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
    }


def test_interval_trigger(spark, tmp_path):
    drop_lines(tmp_path / "in", "1.txt", ROWS)
    writer = queries.file_sink(record_stream(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    query = queries.every_interval(writer).start()
    try:
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)
    finally:
        query.stop()


def test_update_mode_emits_a_window_again_when_it_changes(spark, tmp_path):
    for i, rows in enumerate([[(1.0, "#a", at(1))], [(1.0, "#a", at(2)), (1.0, "#b", at(3))]]):
        drop_lines(tmp_path / "in", f"{i}.txt", rows)
        os.utime(tmp_path / "in" / f"{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    records = record_stream(spark, tmp_path / "in", maxFilesPerTrigger="1")
    trend = trends.window_bounds(queries.popular_trends(records, 0))
    got = run_to_memory(trend, "trend_update", "update", tmp_path / "cp").where(F.col("start") == at(0)).collect()
    assert sorted((r["hashtag"], r["count"]) for r in got) == [("#a", 1), ("#a", 2), ("#b", 1)]


def test_state_can_live_on_disk(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    previous = spark.conf.get(key)
    queries.use_disk_state(spark)
    try:
        drop_lines(tmp_path / "in", "1.txt", ROWS)
        report = queries.trend_report(record_stream(spark, tmp_path / "in"))
        got = run_to_memory(report, "trend_disk", "complete", tmp_path / "cp").collect()
    finally:
        spark.conf.set(key, previous)
    assert got == queries.trend_report(spark.createDataFrame(ROWS, RECORD)).collect()


def test_without_its_connector_the_queue_is_refused(spark, model, tmp_path):
    read, folder = message_folder(tmp_path)
    with pytest.raises(AnalysisException, match="kafka"):
        sources.queue_source(spark, "h:1", "topic")
    for start in [queries.start_hashtag_scoring, queries.start_sentiment_scoring]:
        with pytest.raises(AnalysisException, match="kafka"):
            start(read(spark, folder), model, "h:1", "topic", str(tmp_path / "cp"))


def test_a_stream_cannot_be_sorted_outside_complete_mode(spark, tmp_path):
    drop_lines(tmp_path / "in", "1.txt", ROWS)
    report = queries.trend_report(record_stream(spark, tmp_path / "in"))
    with pytest.raises(AnalysisException, match="[Ss]ort"):
        run_to_memory(report, "sorted_append", "append", tmp_path / "cp")


def test_a_restarted_stream_goes_on_where_it_stopped(spark, model, tmp_path):
    read, folder = message_folder(tmp_path)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for extra in (False, True):
        if extra:
            more = {"lang": "en", "text": "good #again", "createdAt": "2024-01-01T13:00:00Z"}
            (tmp_path / "in" / "n.json").write_text(json.dumps(more), encoding="utf-8")
        queries.until_drained(queries.file_sink(queries.hashtag_lines(read(spark, folder), model), out, checkpoint, "text"))
    got = sorted(r["value"] for r in spark.read.text(out).collect())
    assert got == ['"1.0","good #again","2024-01-01 13:00:00.0"', '"1.0","happy #sun, ""good""","2024-01-01 12:00:00.0"']


def test_a_batch_that_runs_again_is_published_once(spark, tmp_path):
    read, folder = message_folder(tmp_path)
    rows = read(spark, folder).select("text")
    out, state = str(tmp_path / "out"), tmp_path / "state"
    queries.until_drained(queries.publish_batches(rows, out, str(state)))
    first = sorted(r["text"] for r in queries.published(spark, out, rows.schema).collect())
    written = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out" / "batch_id=0").iterdir()}
    for commit in (state / "commits").iterdir():
        if commit.name.strip(".").startswith("0"):
            commit.unlink()
    queries.until_drained(queries.publish_batches(rows, out, str(state)))
    assert sorted(r["text"] for r in queries.published(spark, out, rows.schema).collect()) == first and first
    assert written != {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out" / "batch_id=0").iterdir()}


def test_one_failing_stream_does_not_end_the_other(spark, tmp_path):
    read, folder = message_folder(tmp_path)
    rows = read(spark, folder).select("text")
    broken = rows.select(F.raise_error(F.lit("refused")).cast("string").alias("text"))
    writers = {
        name: queries.file_sink(frame, str(tmp_path / name), str(tmp_path / f"{name}-state"))
        for name, frame in (("broken", broken), ("sound", rows))
    }
    ended = queries.run_together(writers)
    assert ended["sound"] is None and ended["broken"]
    assert spark.read.parquet(str(tmp_path / "sound")).count() > 0


def test_replayed_batches_continue_one_state(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, "#a", at(m)) for m in (1, 120, 2)], RECORD)
    batches = [rows.where(F.col("createdAt") == at(m)) for m in (1, 120, 2)]
    for mode, want in (("complete", 2), ("append", 1)):
        out, state = str(tmp_path / mode), str(tmp_path / f"{mode}-state")
        schema = trends.window_bounds(queries.popular_trends(rows, 0)).schema

        def make(stream, mode=mode, out=out, state=state):
            return queries.publish_batches(trends.window_bounds(queries.popular_trends(stream, 0)), out, state, mode)

        queries.replay(batches, make, str(tmp_path / f"{mode}-in"))
        got = queries.published(spark, out, schema, latest=mode == "complete")
        assert [r["count"] for r in got.where(F.col("start") == at(0)).collect()] == [want]
