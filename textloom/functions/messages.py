"""Message formats of the scored stream."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field order of a scored message and the mark between score and text.
SCORED_FIELDS = ("prediction", "status", "createdAt")
SCORE_MARK = " -- "


def timestamp_text(ts: Column) -> Column:
    """``yyyy-mm-dd hh:mm:ss.f`` with at least one digit of fraction."""
    text = ts.cast("string")
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def quoted(field: Column) -> Column:
    """CSV field in quotes with inner quotes doubled; null becomes an empty, unquoted field."""
    body = F.replace(field, F.lit('"'), F.lit('""'))
    return F.coalesce(F.concat(F.lit('"'), body, F.lit('"')), F.lit(""))


def scored_csv(prediction: Column, status: Column, created_at: Column) -> Column:
    """One CSV line, all fields quoted, without a line end."""
    return F.concat_ws(
        ",", quoted(prediction.cast("string")), quoted(status), quoted(timestamp_text(created_at))
    )


def scored_text(prediction: Column, status: Column) -> Column:
    """``<prediction> -- <status>``."""
    return F.concat(prediction.cast("string"), F.lit(SCORE_MARK), status)


def parse_scored_csv(line: Column) -> Column:
    """Struct ``prediction, status, createdAt`` of one CSV line; a bad field becomes null."""
    raw = F.from_csv(
        line,
        "prediction string, status string, createdAt string",
        {
            "escape": '"',
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
            # Empty in quotes is an empty text; only a field left out is null.
            "emptyValue": "",
            "nullValue": "\0",
            "maxCharsPerColumn": "-1",
        },
    )
    return F.struct(
        raw["prediction"].try_cast("double").alias("prediction"),
        raw["status"].alias("status"),
        raw["createdAt"].try_cast("timestamp").alias("createdAt"),
    )
