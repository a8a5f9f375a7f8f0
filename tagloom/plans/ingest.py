"""Raw CSV to bronze, silver and gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators import cleaning, gold
from tagloom.sources import csv_files
from tagloom.sources.storage import require_paths, scan, write_table


@dataclass(frozen=True)
class Layers:
    """Table locations under one base path."""

    base: str

    def __getattr__(self, name: str) -> str:
        layer, _, table = name.partition("_")
        if layer in ("bronze", "silver", "gold") and table:
            return f"{self.base}/{layer}/{table}"
        raise AttributeError(name)


def land(df: DataFrame, path: str) -> int:
    """Write, then count what was written; returns the row count.

    The source is read once: counting a parquet table reads only file footers.
    (An ``Observation`` would count during the write, but a session that used one
    can no longer apply classifiers that carry a training summary.)
    """
    write_table(df, path)
    return scan(df.sparkSession, path).count()


def land_bronze(
    spark: SparkSession, recipes_csv: str, interactions_csv: str, layers: Layers, *, ranged: bool = True
) -> tuple[int, int]:
    """Both CSVs to parquet, corrupt records kept in their own column.

    A file is read by as many tasks as it has byte ranges; ``ranged=False`` reads
    files whose quotes do not stand only around fields, one task each.
    """
    require_paths(spark, recipes_csv, interactions_csv)
    return (
        land(csv_files.scan_recipes(spark, recipes_csv, ranged=ranged), layers.bronze_recipes),
        land(csv_files.scan_interactions(spark, interactions_csv, ranged=ranged), layers.bronze_interactions),
    )


def build_silver(spark: SparkSession, layers: Layers) -> None:
    recipes, bad_recipes = csv_files.split_corrupt(scan(spark, layers.bronze_recipes))
    reviews, bad_reviews = csv_files.split_corrupt(scan(spark, layers.bronze_interactions))
    write_table(cleaning.clean_recipes(recipes), layers.silver_recipes)
    write_table(cleaning.clean_interactions(reviews), layers.silver_interactions)
    write_table(bad_recipes, layers.bronze_recipes_quarantine)
    write_table(bad_reviews, layers.bronze_interactions_quarantine)


def build_gold(spark: SparkSession, layers: Layers, *, wide: bool = True) -> None:
    """Keyed reviews and recipes; optionally the wide join and its two views."""
    write_table(gold.gold_reviews(scan(spark, layers.silver_interactions)), layers.gold_reviews)
    write_table(gold.gold_recipes(scan(spark, layers.silver_recipes)), layers.gold_recipes)
    if wide:
        joined = gold.gold_wide(scan(spark, layers.gold_reviews), scan(spark, layers.gold_recipes))
        write_table(joined, layers.gold_wide, balance=True)
        written = scan(spark, layers.gold_wide)
        write_table(gold.vector_view(written), layers.gold_vector_view)
        write_table(gold.ratings_view(written), layers.gold_ratings_view)
