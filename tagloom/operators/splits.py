"""Entity-level train/val/test assignment and split tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.keys import split_name


def assign_splits(
    df: DataFrame,
    entity: str = "recipe_id",
    out: str = "split",
    *,
    train: float = 0.8,
    val: float = 0.1,
    test: float = 0.1,
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """Add the split of each row's entity: an expression on the id, no shuffle."""
    return df.withColumn(
        out,
        split_name(F.col(entity), train=train, val=val, test=test, seed=seed, method=method),
    )


def split_table(
    df: DataFrame, key: str = "review_key", entity: str = "recipe_id", split: str = "split"
) -> DataFrame:
    """One (key, entity, split) row per key; a repeated key keeps its least entity."""
    least = F.min(F.struct(entity, split)).alias("kept")
    kept = df.filter(F.col(key).isNotNull()).groupBy(key).agg(least)
    return kept.select(key, f"kept.{entity}", f"kept.{split}")
