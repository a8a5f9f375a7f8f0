"""Column contracts and selections shared by the other operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Iterable[str], label: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{label}: missing required columns {missing}; found {df.columns}")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, close to ``name``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def in_order(df: DataFrame, names: Sequence[str], *, strict: bool = False) -> DataFrame:
    """Select in a stable order; absent names are skipped unless ``strict``."""
    if strict:
        require_columns(df, names, "in_order")
    return df.select(*[n for n in names if n in df.columns])


def without_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with every column present. Plain conditions, so they reach the scan."""
    return df.filter(reduce(and_, [F.col(n).isNotNull() for n in names]))


def unrolled(df: DataFrame, keep: Sequence[str], array: str | Column, name: str) -> DataFrame:
    """One row per array element, null elements and empty arrays left out.

    A plain ``explode`` makes Spark infer "array is not empty" and push it below
    the projection that builds the array, which is then built twice per row. The
    outer form with a filter behind it builds it once.
    """
    values = F.col(array) if isinstance(array, str) else array
    return df.select(*keep, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def unrolled_map(df: DataFrame, keep: Sequence[str], entries: str | Column, key: str, value: str) -> DataFrame:
    """``unrolled`` for a map column: one row per entry."""
    values = F.col(entries) if isinstance(entries, str) else entries
    return df.select(*keep, F.explode_outer(values).alias(key, value)).filter(F.col(key).isNotNull())


def keep_or_derive(df: DataFrame, name: str, derived: Column) -> DataFrame:
    """Keep values already in the column and derive the missing ones."""
    if name in df.columns:
        derived = F.coalesce(F.col(name), derived)
    return df.withColumn(name, derived)
