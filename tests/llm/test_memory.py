"""What Python workers keep in memory between batches and tasks."""

import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import jaccard
from textloom.llm.common import in_batches
from textloom.llm.queries import TOKENIZER

linux = pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")


@linux
def test_memory_freed_by_a_batch_goes_back_to_the_system(spark):
    def measure(batches):
        def held():
            with open("/proc/self/smaps_rollup") as rows:
                return int(re.search(r"Anonymous:\s+(\d+)", rows.read())[1]) // 1024

        pinned = []
        for i, batch in enumerate(batches):
            before = held()
            # Many blocks from the heap of the C library, the last one kept: the rest stays below it when freed.
            blocks = [np.ones(1 << 13) for _ in range(1000)] if i == 0 else []
            pinned += blocks[-1:]
            full = held()
            del blocks
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([before]), pa.array([full])], ["id", "before", "full"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        rows = in_batches(spark.range(0, 2, 1, 1), measure, "id long, before long, full long").orderBy("id").collect()
    finally:
        spark.conf.set(key, kept)
    assert rows[0]["full"] - rows[0]["before"] > 50
    assert rows[1]["before"] - rows[0]["before"] < 20


@linux
def test_encoder_starts_no_threads():
    code = f"""
import os
import numpy as np
from textloom.llm.tokenize import Encoder
words = " ".join(f"word{{i}}x" for i in range(5000)).encode()
encoder = Encoder({TOKENIZER!r})
before = len(os.listdir("/proc/self/task"))
ids = list(encoder.encode(np.frombuffer(words, np.uint8), np.array([0, len(words)])))
assert len(ids[0]) > 5000
print(len(os.listdir("/proc/self/task")) - before)
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env={"PYTHONPATH": ":".join(sys.path)})
    assert run.stdout.split()[-1] == "0"


def test_frequent_shingles_count_the_same_over_several_blocks(spark, monkeypatch):
    texts = [("a b c d e f g",), ("a b c d e f h",), ("x y z u v",), ("a b c d e",)] * 3
    docs = spark.createDataFrame(texts, "text string").coalesce(1)
    whole = jaccard.frequent_shingles(docs, 5)
    assert sorted(whole[1].tolist()) == [3, 3, 3, 6, 9]
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 14)
    values, counts = jaccard.frequent_shingles(docs, 5)
    assert set(values.tolist()) <= set(whole[0].tolist()) and len(values)
