"""From raw documents to packed training windows: four operators, one after another.

Each stage gets the documents that the one before it kept, as a written table, and
all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import packing, quality, simhash, toxicity
from tagloom.sources.storage import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models accept."""
    return toxicity.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest key of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 1, size=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("simhash near-dedup", one_of_each),
    ("packing", packed),
]

#: Trained models and fingerprints are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialise(docs, "stage")
    return docs
