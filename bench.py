"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default
8) the local cores. Each query runs twice and the second time counts, so that
JVM and Python worker start-up is not what is measured. Jobs (JOBS), which write
tables and train models, run once. Results go to Spark's ``noop`` sink:
everything is computed, nothing is written.

A supplied table of texts is one file with one row group, which one task must
read. Before the clock starts, those tables are laid out as one file per core in
a scratch folder, as a table of that kind would be stored; ``layout_sec`` is
what that took.

``tag_corpus`` is the tagging of all documents with a run's stored models, and the
write of the tagged table, timed alone; ``tag_corpus_build_sec`` is the run before it.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from tagloom.catalog import QUERIES
from tagloom.catalog.bindings import CORPUS_TAXONOMY
from tagloom.catalog.modelling import run_on_documents
from tagloom.operators.text_features import Word2VecSpec
from tagloom.plans.tagging import tag_corpus

HEADLINE = (
    "normalize_text", "gold_reviews", "gold_wide", "wide_join", "entity_split", "entity_stats",
    "top_bigrams", "stopword_filtered_counts", "saved_token_stages", "tfidf_by_term", "tfidf_hashed",
    "hash_ordered_sample", "union_one_per_key", "assign_with_fallback", "polarity_diagnostics",
    "tag_centroids", "diagonal_thresholds", "similarity_wide", "similarity_wide_native", "similarity_long",
    "tag_vectors", "cooccurrence", "threshold_sweep", "multi_tag_benchmark", "confusion_at_threshold",
)

JOBS = ("hot_key_join", "embed_from_table", "resumable_labelling", "factorised_embedding", "corpus_tagging")
TAGGING = "tag_corpus"
TEXT_TABLES = ("documents.parquet", "conversations.parquet")


def laid_out(spark: SparkSession, folder: str, scratch: str, files: int) -> str:
    """The folder's tables, texts in as many files as there are cores, all others linked."""
    for name in os.listdir(folder):
        if name in TEXT_TABLES:
            spark.read.parquet(f"{folder}/{name}").repartition(files).write.parquet(f"{scratch}/{name}")
        else:
            os.symlink(f"{folder}/{name}", f"{scratch}/{name}")
    return scratch


def timed_tagging(spark: SparkSession, folder: str) -> tuple[float, float]:
    """(seconds to build a run with quickly trained vectors, seconds to tag and write all documents with it)."""
    start = time.perf_counter()
    base, run_id = run_on_documents(spark, folder, vectors=Word2VecSpec(size=128, iterations=1))
    built = time.perf_counter()
    tag_corpus(spark, base, run_id, f"{base}/reviews", f"{base}/gold", tags=CORPUS_TAXONOMY.ids)
    return built - start, time.perf_counter() - built


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="tagloom-bench-")
    start = time.perf_counter()
    data = laid_out(spark, folder, scratch, int(cpus))
    layout = round(time.perf_counter() - start, 3)
    rows = spark.read.parquet(f"{folder}/documents.parquet").count()
    seconds = {}
    build = None
    for name in sys.argv[1:] or (*HEADLINE, TAGGING, *JOBS):
        if name == TAGGING:
            build, seconds[name] = (round(x, 3) for x in timed_tagging(spark, data))
            continue
        for _ in range(1 if name in JOBS else 2):
            start = time.perf_counter()
            QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    shutil.rmtree(scratch)
    headline = round(sum(v for k, v in seconds.items() if k not in (*JOBS, TAGGING)), 3)
    report = {"metric": "total_seconds", "value": headline, "unit": "sec", "queries": seconds, "sf": folder, "layout_sec": layout}
    if TAGGING in seconds:
        report["tag_corpus_build_sec"] = build
        report["documents_tagged_per_sec"] = round(rows / seconds[TAGGING], 1)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
