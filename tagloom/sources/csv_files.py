"""CSV scans. Quoted fields may hold newlines, so Spark's own reader takes a whole file
in one task. ``ranged`` scans cut large files into records by byte ranges first
(``csv_ranges``) and give the same rows for files whose quotes stand only around
fields; everything after the landing is parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tagloom.sources import csv_ranges
from tagloom.sources.schemas import CORRUPT_COLUMN, INTERACTIONS_CSV, RECIPES_CSV


OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}


def _reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.options(header=True, **OPTIONS)


def scan_typed(spark: SparkSession, path: str | list[str], schema: str, *, ranged: bool = False) -> DataFrame:
    """Typed scan; a record that does not fit is kept whole in ``_corrupt_record``."""
    options = {"columnNameOfCorruptRecord": CORRUPT_COLUMN}
    full = f"{schema}, {CORRUPT_COLUMN} string"
    if not ranged:
        return _reader(spark).options(**options).schema(full).csv(path)
    rows = csv_ranges.records(spark, path).filter(~F.col("header"))
    return rows.select(F.from_csv("record", full, OPTIONS | options).alias("row")).select("row.*")


def scan_recipes(spark: SparkSession, path: str | list[str], *, ranged: bool = False) -> DataFrame:
    return scan_typed(spark, path, RECIPES_CSV, ranged=ranged)


def scan_interactions(spark: SparkSession, path: str | list[str], *, ranged: bool = False) -> DataFrame:
    return scan_typed(spark, path, INTERACTIONS_CSV, ranged=ranged)


def scan_untyped(spark: SparkSession, path: str | list[str], *, ranged: bool = False) -> DataFrame:
    """Every column as string, named by the header; with ``ranged`` all files must have the same."""
    rows = _reader(spark).option("enforceSchema", False).csv(path)
    if not ranged:
        return rows
    found = csv_ranges.records(spark, path)
    headers = found.filter("header").select("record").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"Headers differ: {[r['record'] for r in headers]}")
    names = ", ".join(f"`{name.replace('`', '``')}` string" for name in rows.columns)
    return found.filter(~F.col("header")).select(F.from_csv("record", names, OPTIONS).alias("row")).select("row.*")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined rows).

    Apply to a landed table: Spark refuses to answer from a CSV scan that is
    pruned to the corrupt column alone.
    """
    bad = F.col(CORRUPT_COLUMN)
    return df.filter(bad.isNull()).drop(CORRUPT_COLUMN), df.filter(bad.isNotNull())
