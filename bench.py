"""Headline queries on the tables of one scale; prints one JSON line, also if it is ended early."""

from __future__ import annotations

import json
import os
import signal
import sys
import time

from pyspark.sql import SparkSession

from feedback_lens.catalog import all_queries
from feedback_lens.catalog import fixtures as fx
from feedback_lens.session import tuned

HEADLINE = (
    "corpus_of_three_shops",
    "prepared_reviews",
    "tfidf_rows",
    "noun_phrases",
    "similarity_report",
    "coherence_by_windows",
    "topic_result_rows",
    "lda_grid",
    "hdp_report",
    "lsa_report",
    "kmeans_report",
    "fixed_lda_report",
)


def report(seconds: dict[str, float], sf: str) -> None:
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}), flush=True)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cores}]").appName("feedback_lens_bench")
    spark = (
        tuned(builder)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Lexicon and vectors are inputs; building their stand-ins is not part of any query.
    for build in (fx.lexicon, fx.word_vectors):
        build(spark, sf).count()
    seconds: dict[str, float] = {}

    def ended(*_: object) -> None:
        report(seconds, sf)
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    for name in HEADLINE:
        start = time.time()
        all_queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    report(seconds, sf)
    spark.stop()


if __name__ == "__main__":
    main()
