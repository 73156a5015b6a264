"""Running totals behind the offsets of annotations."""

from itertools import accumulate

from pyspark.sql import functions as F

from textloom.functions.annotations import running_total, spans


def test_running_total_of_every_size_up_to_two_strides_past_64(spark):
    rows = [(n, [(7 * i * i + n) % 11 for i in range(n)]) for n in range(68)]
    docs = spark.createDataFrame(rows, "n int, numbers array<int>")
    found = {r["n"]: r["sums"] for r in docs.select("n", running_total(F.col("numbers")).alias("sums")).collect()}
    assert found == {n: list(accumulate(numbers)) for n, numbers in rows}


def test_running_total_of_null_is_null(spark):
    docs = spark.createDataFrame([(None,)], "numbers array<int>")
    assert docs.select(running_total(F.col("numbers"))).first()[0] is None


def test_running_total_tries_only_the_strides_it_needs(spark):
    plan = spark.createDataFrame([([1],)], "numbers array<int>").select(running_total(F.col("numbers")))
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "filter(" not in text and "CASE WHEN" not in text


def test_spans_add_their_base_and_count_characters(spark):
    docs = spark.createDataFrame([("  é1 .b ",), ("",), (None,), ("   ",)], "text string")
    found = [r[0] for r in docs.select(spans(F.col("text"), r"[^\s.]+", base=F.lit(10))).collect()]
    assert [tuple(s) for s in found[0]] == [(12, 13, "é1"), (16, 16, "b")]
    assert found[1:] == [[], None, []]
