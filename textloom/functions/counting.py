"""Words of a text counted in Arrow batches."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# The words between ``WORD_GAPS`` of a text in lower case.
WORD = "[a-z0-9_]+"
# Rows handed back at once, give or take one document.
COUNTED_ROWS = 1 << 17


def count_batches(
    size: int, dropped: Sequence[str], cut: int | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of ``id, text`` as batches of ``id, word, n``: each distinct run of ``size`` words of each row.

    Texts are in lower case. Words of ``dropped`` are left out before runs are formed; the words of a run are
    joined with one space. With ``cut`` only the first so many characters of each word are kept. Rows are read one at a time, so a task holds the words of one text.
    """
    find, stops = re.compile(WORD).findall, frozenset(dropped)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, words, n = batch.column(0), [], [], []

            def taken() -> pa.RecordBatch:
                columns = [ids.take(pa.array(np.repeat(*np.array(rows, np.int64).reshape(-1, 2).T)))]
                columns += [pa.array(words, pa.string()), pa.array(n, pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=["doc_id", "word", "n"])

            for row, text in enumerate(batch.column(1)):
                found = find(text.as_py() or "")
                if stops:
                    found = [w for w in found if w not in stops]
                if cut is not None:
                    found = [w[:cut] for w in found]
                if size > 1:
                    found = map(" ".join, zip(*(found[k:] for k in range(size))))
                held = Counter(found)
                rows.append((row, len(held)))
                words.extend(held)
                n.extend(held.values())
                if len(words) >= COUNTED_ROWS:
                    yield taken()
                    rows, words, n = [], [], []
            yield taken()

    return counted


cloudpickle.register_pickle_by_value(sys.modules[__name__])
