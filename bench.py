"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the warm runs (median is taken).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from socialtext.catalog import QUERIES
from socialtext.session import build_session

HEADLINE = [
    "top_terms_by_lang", "split_tokens", "clean_text", "special_tokens", "ngrams", "bow", "tfidf_log2", "npmi_pairs",
    "phrase_merge", "language_guess", "stem_vocab", "u_mass", "c_npmi", "sigma_filter", "root_n_sample",
    "sampled_semi_intersection", "top_score_per_group", "random_per_group", "insert_ignore", "newest_wins",
    "keep_first", "daily_counts", "time_slice_counts", "key_join", "embedded_explode", "class_similarity",
    "fold_assign", "nb_classifier", "lda_topics",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                             "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):  # compile the plans once on the smallest tables
        for name in HEADLINE:
            run(spark, name, warm)
        spark.catalog.clearCache()
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
