"""Batch sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators.filters import with_text

# Columns of a document file and of a labelled message file.
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("docIndex", T.LongType()),
        T.StructField("Item Type", T.StringType()),
        T.StructField("Publication Year", T.IntegerType()),
        T.StructField("Author", T.StringType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Publication Title", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
LABELLED_SCHEMA = T.StructType(
    [
        T.StructField("label", T.DoubleType()),
        T.StructField("id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def read_csv_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = DOCUMENT_SCHEMA,
    multi_line: bool = False,
) -> DataFrame:
    """Documents from CSV files with a header; rows without text are dropped.

    Columns are found by their name in the header, in any order; those that ``schema`` does not name are
    left out, and those that it names but the files lack are null. Files without a ``text`` column are an
    error. A value that its type cannot hold is null. All files of ``path`` have the same header.
    ``schema=None`` infers the types of all columns with one more pass over the files. ``multi_line``
    accepts line breaks inside quotes; such files cannot be split between tasks.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is None:
        rows = reader.option("inferSchema", True).csv(path)
    else:
        rows = reader.csv(path)
    if "text" not in rows.columns:
        raise ValueError(f"no column text among {rows.columns}")
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        rows = rows.select(*[_typed(rows, field) for field in wanted])
    return with_text(rows)


def _typed(rows: DataFrame, field: T.StructField) -> Column:
    """The column of a field's name, cast to its type where the value allows."""
    value = F.col(f"`{field.name}`").try_cast(field.dataType) if field.name in rows.columns else F.lit(None)
    return value.cast(field.dataType).alias(field.name)


def read_labelled_csv(spark: SparkSession, path: str) -> DataFrame:
    """``label, status`` from CSV files of six columns without a header."""
    return spark.read.schema(LABELLED_SCHEMA).option("escape", '"').csv(path).select("label", "status")


def literal_documents(spark: SparkSession, sentences: Sequence[str]) -> DataFrame:
    """A ``text`` table of given sentences."""
    return spark.createDataFrame([(s,) for s in sentences], "text string")


def read_collection(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    columns: Sequence[str] = ("docIndex", "text", "mongoSetId"),
) -> DataFrame:
    """Documents of a collection: files, or a document store whose connector is on the classpath."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path).select(*columns)


def read_lexicon(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``term, tag`` rows of an entity dictionary; lines without a tag are dropped."""
    rows = spark.read.schema("term string, tag string").option("sep", sep).csv(path)
    return rows.where(F.col("term").isNotNull() & F.col("tag").isNotNull())


def read_tagged_corpus(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """``word, pos`` rows of text files with tokens written as word, separator, tag."""
    tokens = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("t"))
    rows = tokens.where(F.contains("t", F.lit(sep))).select(
        F.substring_index("t", sep, 1).alias("word"), F.substring_index("t", sep, -1).alias("pos")
    )
    return rows.where((F.col("word") != "") & (F.col("pos") != ""))
