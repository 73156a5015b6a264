"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables     (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the session     (default 8)
BENCH_RUNS    timed runs per query, after one warm-up (default 3); the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from contract.queries import QUERIES
from textloom.session import get_session

HEADLINE = [
    "tokenize_regex",
    "word_counts_in_place",
    "vocabulary_fit",
    "doc_features",
    "ngram_dictionary",
    "union_stems_bigrams",
    "stem_words",
    "analyze_text_features",
    "analyze_text_ngrams",
    "windowed_trend",
    "extract_hashtags",
    "tokenize_annotations",
    "tag_pos",
    "pos_words_by_vocabulary",
    "entity_counts",
    "nb_log_theta",
    "sentiment_score",
    "stateful_trend_query",
    "micro_batch_score",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}))


if __name__ == "__main__":
    main(sys.argv[1:])
