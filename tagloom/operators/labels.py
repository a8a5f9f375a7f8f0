"""Label arrays to 0/1 columns and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.contracts import require_columns


def multi_hot(
    df: DataFrame,
    labels: Sequence[str],
    source: str = "zs_labels",
    *,
    prefix: str = "y_",
    dtype: str = "int",
) -> DataFrame:
    """One 0/1 column per label; a null array is all zeros."""
    require_columns(df, [source], "multi_hot")

    def flag(label: str) -> Column:
        return F.coalesce(F.array_contains(F.col(source), label), F.lit(False)).cast("int").cast(dtype)

    return df.withColumns({f"{prefix}{label}": flag(label) for label in labels})


def tags_set(tags: Sequence[str], prefix: str) -> Column:
    """Array of the tags whose ``<prefix><tag>`` column is 1, in the given order."""
    return F.array_compact(F.array(*[F.when(F.col(f"{prefix}{t}") == 1, F.lit(t)) for t in tags]))


def with_tag_list(
    df: DataFrame, tags: Sequence[str], prefix: str = "pred_",
    out: str = "tag_list", total: str = "total_tags",
) -> DataFrame:
    listed = df.withColumn(out, tags_set(tags, prefix))
    return listed.withColumn(total, F.size(out))


def row_total(columns: Sequence[str]) -> Column:
    """Sum of the 0/1 columns of a row."""
    return reduce(add, [F.col(c) for c in columns])
