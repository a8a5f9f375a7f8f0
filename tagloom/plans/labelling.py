"""Weak labelling of a sample: prepare, label (resumable), attach.

The unit of work is a chunk, a folder of the input. What is done is what the log beside
the output says, never what the output happens to hold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.cleaning import with_min_tokens
from tagloom.operators.gold import attach_by_key
from tagloom.operators.selection import sample_cut
from tagloom.operators.training import side_by_side
from tagloom.operators.weak_labels import Scorer, WeakLabelConfig, label
from tagloom.sources.storage import create_if_absent, scan, small_files, write_table

CHUNK = "chunk"
LOG_SCHEMA = f"{CHUNK} int, rows long, digest long"


def choose(reviews: DataFrame, cfg: WeakLabelConfig) -> DataFrame:
    """(key, text, token_count) of the sampled, long enough reviews."""
    eligible = with_min_tokens(reviews, cfg.min_tokens, cfg.text)
    chosen = sample_cut(eligible.select(cfg.key), cfg.sample_n, cfg.key, seed=cfg.seed)
    # The cheap cut stands before the tokens are counted again.
    return with_min_tokens(reviews.filter(chosen), cfg.min_tokens, cfg.text).select(cfg.key, cfg.text, "token_count")


def prepare(
    spark: SparkSession, reviews_path: str, out: str, cfg: WeakLabelConfig, *, chunk_rows: int = 500_000
) -> str:
    """Write the sample, one folder per chunk, so a chunk reads only its own files."""
    chunks = max(1, ceil(cfg.sample_n / chunk_rows))
    chosen = choose(scan(spark, reviews_path, required=[cfg.key, cfg.text]), cfg)
    placed = chosen.withColumn(CHUNK, F.pmod(F.xxhash64(cfg.key), F.lit(chunks)).cast("int"))
    return write_table(placed, out, partition_by=[CHUNK], balance=True)


def _log(output_path: str) -> str:
    return f"{output_path}/_log"  # readers of the table skip names that begin so


def committed(spark: SparkSession, output_path: str) -> dict[int, tuple[int, int]]:
    """{chunk: (rows, digest)} of the chunks that are done; the log is read, not the table."""
    files = list(small_files(spark, _log(output_path)).values())
    rows = spark.read.schema(LOG_SCHEMA).json(files).collect() if files else []
    return {r[CHUNK]: (r["rows"], r["digest"]) for r in rows}


def labelled(spark: SparkSession, output_path: str) -> DataFrame:
    """The labels of committed chunks; without a log the whole table, as ``label_once`` writes it."""
    stored = spark.read.parquet(output_path)
    if CHUNK not in stored.columns:
        return stored
    done = list(committed(spark, output_path))
    return stored.filter(F.col(CHUNK).isin(done)) if done else stored.limit(0)


def pending(spark: SparkSession, input_path: str, output_path: str) -> DataFrame:
    """Input rows of the chunks without a commit."""
    done = list(committed(spark, output_path))
    todo = spark.read.parquet(input_path)
    return todo.filter(~F.col(CHUNK).isin(done)) if done else todo


def _content(rows: DataFrame, key: str) -> tuple[int, int]:
    """(rows, digest of their keys); the digest does not depend on order."""
    found = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(F.xxhash64(key)), F.lit(0)).alias("digest")).first()
    return found["rows"], found["digest"]


def label_pending(
    spark: SparkSession, input_path: str, output_path: str, cfg: WeakLabelConfig,
    load: Callable[[], Scorer] | None = None, *, chunks: Sequence[int] | None = None, parallelism: int = 2,
) -> int:
    """Label the chunks that have no commit, ``parallelism`` at a time; returns the rows labelled.

    A chunk's folder is written anew, counted, and then entered in the log by a
    file that is created last. Whatever an attempt without an entry has left is
    overwritten, so a failure leaves no half rows and no double ones, and the next
    call goes on with the chunks that are not in the log. ``chunks`` restricts the
    call. A failed chunk raises its error after the others have ended.
    """
    todo = spark.read.parquet(input_path)
    done = committed(spark, output_path)
    left = sorted(r[CHUNK] for r in todo.select(CHUNK).distinct().collect() if r[CHUNK] not in done)
    if chunks is not None:
        left = [chunk for chunk in left if chunk in chunks]

    def run(chunk: int) -> int:
        folder = f"{output_path}/{CHUNK}={chunk}"
        write_table(label(todo.filter(F.col(CHUNK) == chunk), cfg, load), folder)
        rows, digest = _content(spark.read.parquet(folder), cfg.key)
        entry = json.dumps({CHUNK: chunk, "rows": rows, "digest": digest})
        create_if_absent(spark, f"{_log(output_path)}/{chunk:012d}.json", entry)
        return rows

    return sum(side_by_side(todo, [lambda chunk=chunk: run(chunk) for chunk in left], parallelism))


def changed_chunks(spark: SparkSession, output_path: str, key: str) -> list[int]:
    """Committed chunks whose rows are no longer those of their log entry."""
    digest = F.coalesce(F.bit_xor(F.xxhash64(key)), F.lit(0))
    found = spark.read.parquet(output_path).groupBy(CHUNK).agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest"))
    stored = {r[CHUNK]: (r["rows"], r["digest"]) for r in found.collect()}
    return sorted(chunk for chunk, entry in committed(spark, output_path).items() if stored.get(chunk, (0, 0)) != entry)


def label_once(
    spark: SparkSession, input_path: str, output_path: str, cfg: WeakLabelConfig,
    load: Callable[[], Scorer] | None = None,
) -> str:
    """Label the whole input in one job, replacing the output."""
    labelled = label(spark.read.parquet(input_path), cfg, load)
    return write_table(labelled, output_path)


def attach(spark: SparkSession, reviews_path: str, labels_path: str, out: str, key: str = "review_key") -> str:
    """Reviews that have labels, with them, as a table."""
    labels = labelled(spark, labels_path).drop(CHUNK)
    return write_table(attach_by_key(spark.read.parquet(reviews_path), labels, key), out)
