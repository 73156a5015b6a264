"""Document quality by lines first: failing lines are removed, then documents that lose too much text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import in_batches

# Fixed values of the base rules: least words, and percent of words inside repeated windows of WIDTH words.
LEAST_WORDS, MOST_REPEATED, WIDTH = 10, 20, 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# A longer line is read word by word.
LONG_LINE = 1 << 20

# Rules of lines. A line of PROSE_WORDS words or more has to end like a sentence, a quotation or a list head, and
# to hold at most one symbol for so many words.
PROSE_WORDS, WORDS_PER_SYMBOL = 6, 5
LINE_ENDS = (".", "!", "?", ":", ";", "…", '"', "'", "”", "’", "»", ")", "]")
# Two separators of a menu or more, or nothing but words of a menu.
NAVIGATION = (
    r"[|»›•·][^|»›•·]*[|»›•·]|^[ \t]*(?:(?:home|menu|search|login|log in|log out|sign in|sign up|register|contact|contact us"
    r"|about|about us|help|faq|sitemap|next|previous|back|back to top|read more|skip to content|share|print)[ \t>/-]*)+\r?$"
)
BOILERPLATE = (
    r"all rights reserved|cookie policy|uses cookies|privacy policy|terms of use|terms of service|enable javascript"
    r"|licensed under|released under the|powered by|subscribe to our|click here|copyright ©|copyright \(c\)|© [0-9]{4}"
)
# Percent of a document's words that removed lines may hold.
MOST_LOST = 50

_NAVIGATION, _BOILERPLATE = re.compile(NAVIGATION), re.compile(BOILERPLATE)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_failed_lines long, lost_words long, base_failed boolean, kept boolean, cleaned string"
)


def line_words(line: str) -> Iterable[str]:
    if len(line) <= LONG_LINE:
        return WORD.findall(line)
    return (m.group() for m in WORD.finditer(line))


def symbols(text: str) -> int:
    return sum(map(text.count, SYMBOLS))


def line_fails(line: str, n_words: int) -> bool:
    """Whether a line with words breaks the punctuation, the navigation or the boilerplate rule."""
    if n_words >= PROSE_WORDS:
        if not line.rstrip(BLANKS).endswith(LINE_ENDS) or WORDS_PER_SYMBOL * symbols(line) > n_words:
            return True
    low = line.translate(_LOWER)
    return bool(_NAVIGATION.search(low) or _BOILERPLATE.search(low))


def pairs_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs only, below the number of pairs."""
    both = left * (int(right.max()) + 1) + right
    return np.unique(both, return_inverse=True)[1]


def repeated_words(ids: np.ndarray, width: int = WIDTH) -> int:
    """Words inside windows of ``width`` words that stand twice or more; ``ids`` are numbers of words."""
    if len(ids) <= width:
        return 0
    windows = ids[: len(ids) - width + 1]
    for i in range(1, width):
        windows = pairs_of(windows, ids[i : len(ids) - width + 1 + i])
    found = np.flatnonzero(np.bincount(windows)[windows] > 1)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, found, 1)
    np.add.at(edges, found + width, -1)
    return int((np.cumsum(edges) > 0).sum())


@dataclass
class Judged:
    """What the rules say of one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int
    n_failed_lines: int
    lost_words: int
    base_failed: bool
    kept: bool
    cleaned: str


def judge(text: str, most_lost: int = MOST_LOST) -> Judged:
    known: dict[str, int] = {}
    parts: list[np.ndarray] = []
    seen: set[str] = set()
    left: list[str] = []
    lines = dup = failed = lost = 0
    for line in text.split("\n"):
        ids = np.fromiter((known.setdefault(w, len(known)) for w in line_words(line)), np.int64)
        if not len(ids):
            left.append(line)
            continue
        parts.append(ids)
        lines += 1
        dup += line in seen
        seen.add(line)
        if line_fails(line, len(ids)):
            failed += 1
            lost += len(ids)
        else:
            left.append(line)
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    n, repeated = len(ids), repeated_words(ids)
    base = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    return Judged(
        n,
        len(text) - sum(map(text.count, BLANKS)),
        symbols(text),
        dup,
        repeated,
        lines,
        failed,
        lost,
        base,
        not base and 100 * lost <= most_lost * n,
        "\n".join(left),
    )


def line_quality(docs: DataFrame, most_lost: int = MOST_LOST) -> DataFrame:
    """Counts, verdict and cleaned text of every row of ``docs``: see SCHEMA.

    Words stand between ASCII blanks, lines between line feeds; a line counts if it holds a word. Base rules: a document
    of fewer than LEAST_WORDS words fails, and one with more than MOST_REPEATED percent of its words inside
    windows of WIDTH words that stand in it twice.

    Method: first each line is judged. It is removed if it is prose without an end mark or full of symbols, a row of menu entries, or
    a notice (rights, cookies, licence). ``cleaned`` is the text without those lines. Then a document whose removed
    lines hold more than ``most_lost`` percent of its words is rejected. Words are numbered and windows compared
    by numbers, not by hash. Every row is judged on its own and no row is shuffled.

    Edge cases: a null text has no words, fails and keeps a null cleaned text; an empty or blank text fails; repeated
    rows give repeated results; rows without ``doc_id`` are judged too; an empty table gives no rows; other columns
    are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [vars(judge(text or "", most_lost)) for text in texts]
            for text, row in zip(texts, found):
                row["cleaned"] = None if text is None else row["cleaned"]
            kinds = dict.fromkeys(names, pa.int64()) | {"base_failed": pa.bool_(), "kept": pa.bool_(), "cleaned": pa.string()}
            columns = [pa.array([row[name] for row in found], kinds[name]) for name in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rows, SCHEMA)


def clean_documents(docs: DataFrame, most_lost: int = MOST_LOST) -> DataFrame:
    """``docs`` rows that are kept, with all columns, their text without the failing lines."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            found = [judge(text or "", most_lost) for text in batch.column(at).to_pylist()]
            cleaned = pa.array([j.cleaned for j in found], batch.schema.field(at).type)
            kept = pa.array([j.kept for j in found], pa.bool_())
            yield batch.set_column(at, batch.schema.field(at), cleaned).filter(kept)

    return in_batches(docs, rows, docs.schema)
