"""Annotation arrays: spans of a text with their offsets, built inside the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import bind

ANNOTATION_TYPE = (
    "array<struct<annotatorType:string,begin:int,end:int,result:string,metadata:map<string,string>>>"
)
# A sentence runs to a full stop, question or exclamation mark before whitespace, or to the end: runs of
# visible characters, each after one that does not end in such a mark. Nothing is tried twice.
SENTENCE = r"\S++(?:(?<![.!?])\s++\S++)*+"
# A token is a run of word characters or one other visible character.
TOKEN = r"\w+|[^\w\s]"
# Distances of the doubling passes; enough for the longest array Spark can hold.
_STRIDES = [1 << k for k in range(31)]


def running_total(numbers: Column) -> Column:
    """Prefix sums of an array in log2(n) passes over it.

    Each pass adds the value one stride to the left and doubles the stride, so long texts cost
    n log n and never a copy per element.
    """
    # As many strides as the last place has binary digits; one for an empty array, where it adds nothing.
    last = F.greatest(F.size(numbers) - 1, F.lit(0))
    strides = F.slice(F.array(*[F.lit(s) for s in _STRIDES]), F.lit(1), F.length(F.bin(last.cast("long"))))
    return F.aggregate(
        strides,
        numbers,
        lambda sums, s: F.transform(sums, lambda v, i: v + F.coalesce(F.get(sums, i - s), F.lit(0))),
    )


def _span(begin: Column, end: Column, result: Column) -> Column:
    return F.struct(begin.alias("begin"), end.alias("end"), result.alias("result"))


def spans(
    text: Column, pattern: str, build: Callable[[Column, Column, Column], Column] = _span, base: Column | None = None
) -> Column:
    """Array of ``begin, end, result`` for each match; both ends counted in characters, inclusive.

    ``base`` is added to both ends; ``build`` makes another element of the three values.
    """

    def locate(parts: Column) -> Column:
        # What stands before a match and the match itself; there is one more gap, after the last match.
        gaps = F.slice(parts["gaps"], F.lit(1), F.size(parts["found"]))
        steps = F.zip_with(parts["found"], gaps, lambda hit, gap: F.length(gap) + F.length(hit))

        def element(hit, end):
            end = end if base is None else base + end
            return build(end - F.length(hit), end - 1, hit)

        return F.zip_with(parts["found"], bind(steps, running_total), element)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern)
    return bind(F.struct(found.alias("found"), gaps.alias("gaps")), locate)


def _annotation(kind: str, begin: Column, end: Column, result: Column, metadata: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("annotatorType"),
        begin.alias("begin"),
        end.alias("end"),
        result.alias("result"),
        metadata.alias("metadata"),
    )


def document_annotation(text: Column) -> Column:
    """The whole text as an array of one annotation."""
    no_metadata = F.create_map().cast("map<string,string>")
    return F.array(_annotation("document", F.lit(0), F.length(text) - 1, text, no_metadata))


def sentence_annotations(document: Column, pattern: str = SENTENCE) -> Column:
    """Sentences of a document annotation, numbered from 0 in ``metadata.sentence``."""
    return F.transform(
        spans(F.get(document, F.lit(0))["result"], pattern),
        lambda s, i: _annotation(
            "sentence", s["begin"], s["end"], s["result"], F.create_map(F.lit("sentence"), i.cast("string"))
        ),
    )


def token_annotations(sentences: Column, pattern: str = TOKEN) -> Column:
    """Tokens of all sentences with offsets in the document and the metadata of their sentence."""

    def of_sentence(s):
        def token(begin, end, result):
            return _annotation("token", begin, end, result, s["metadata"])

        return spans(s["result"], pattern, token, s["begin"])

    return F.flatten(F.transform(sentences, of_sentence))
