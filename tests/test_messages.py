import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import messages as msg
from textloom.streaming.sources import scored_records

SCHEMA = "prediction double, status string, createdAt timestamp"
relaxed = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
MOMENT = dt.datetime(2024, 1, 2, 3, 4, 5)


def csv_column():
    return msg.scored_csv(F.col("prediction"), F.col("status"), F.col("createdAt")).alias("value")


def test_csv_line(spark):
    rows = [(1.0, 'say "hi", all', MOMENT), (0.0, " x ", MOMENT.replace(microsecond=120000)), (1.0, None, MOMENT)]
    got = [r["value"] for r in spark.createDataFrame(rows, SCHEMA).select(csv_column()).collect()]
    assert got == [
        '"1.0","say ""hi"", all","2024-01-02 03:04:05.0"',
        '"0.0"," x ","2024-01-02 03:04:05.12"',
        '"1.0",,"2024-01-02 03:04:05.0"',
    ]


def test_text_line(spark):
    df = spark.createDataFrame([(1.0, "good day", MOMENT)], SCHEMA)
    line = df.select(msg.scored_text(F.col("prediction"), F.col("status")).alias("v")).first()["v"]
    assert line == "1.0 -- good day"


@relaxed
@given(
    st.lists(
        st.tuples(
            st.floats(allow_nan=False, allow_infinity=False),
            st.text('ab ",\\\n#é日\t;', max_size=25),
            st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1)),
        ),
        min_size=1,
        max_size=20,
    )
)
def test_parse_reads_back_what_format_wrote(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    parsed = df.select(msg.parse_scored_csv(csv_column()).alias("r")).select("r.*")
    assert [tuple(r) for r in parsed.collect()] == rows


def test_bad_lines_go_to_the_rejects(spark):
    good = '"1.0","a ""quoted"" word, here","2024-01-02 03:04:05.0"'
    bad = ['"x","s","2024-01-02 03:04:05.0"', '"1.0","s"', '"1.0","s","yesterday"', "", '"1.0",,"2024-01-02 03:04:05.0"']
    lines = spark.createDataFrame([(v,) for v in [good, *bad]], "value string")
    records, rejects = scored_records(lines)
    assert [tuple(r) for r in records.collect()] == [(1.0, 'a "quoted" word, here', MOMENT)]
    assert sorted(r["value"] for r in rejects.collect()) == sorted(bad)


def test_a_bad_field_leaves_the_others(spark):
    lines = spark.createDataFrame([('"oops","s","2024-01-02 03:04:05.0"',)], "value string")
    row = lines.select(msg.parse_scored_csv(F.col("value")).alias("r")).select("r.*").first()
    assert tuple(row) == (None, "s", MOMENT)
