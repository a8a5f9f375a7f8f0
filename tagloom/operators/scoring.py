"""Score every row against every tag centroid, wide or long, and apply thresholds.

There is one centroid for each tag of the taxonomy. They are read once and ride along
with the plan, in blocks of bounded size; rows are never joined, copied or shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.vectors import dot, matrix_product, norm, raw_array_column, unit_rows
from tagloom.operators.contracts import free_name

# Bytes of unit vectors that one plan carries; more are scored in blocks of tags.
BLOCK_BYTES = 8 * 1024 * 1024


@dataclass(frozen=True)
class TagModel:
    """Unit centroids and thresholds, in tag order."""

    tags: tuple[str, ...]
    units: np.ndarray
    thresholds: Mapping[str, float]

    @classmethod
    def load(cls, calibrated: DataFrame) -> "TagModel":
        """Read (tag, centroid[, threshold]) rows: one per tag of the taxonomy, the only model there is."""
        wanted = [c for c in ("tag", "centroid", "threshold") if c in calibrated.columns]
        rows = calibrated.select(*wanted).collect()
        rows = sorted((r for r in rows if r["centroid"] is not None), key=lambda r: r["tag"])
        if not rows:
            raise ValueError("No centroids to score against")
        thresholds = (
            {r["tag"]: r["threshold"] for r in rows if r["threshold"] is not None}
            if "threshold" in wanted
            else {}
        )
        return cls(
            tuple(r["tag"] for r in rows), unit_rows([list(r["centroid"]) for r in rows]), thresholds
        )

    def with_thresholds(self, thresholds: Mapping[str, float]) -> "TagModel":
        return TagModel(self.tags, self.units, dict(thresholds))


def similarities(vector: Column, model: TagModel, engine: str = "arrow") -> Column:
    """``array<double>``: cosine to each centroid, in ``model.tags`` order.

    ``arrow`` multiplies whole batches; ``native`` stays in the JVM and shares
    the row's norm across tags. They agree to rounding.
    """
    if engine == "arrow":
        block = max(1, BLOCK_BYTES // max(1, model.units[:1].nbytes))
        blocks = [model.units[k : k + block] for k in range(0, len(model.units), block)]
        scores = [matrix_product(units, unit_input=True)(vector) for units in blocks]
        return scores[0] if len(scores) == 1 else F.concat(*scores)
    if engine != "native":
        raise ValueError(f"Unknown scoring engine: {engine}")
    vector = vector.cast("array<double>")
    length = norm(vector)
    products = F.array(*[dot(vector, F.lit([float(v) for v in u])) for u in model.units])
    scaled = F.transform(products, lambda p: p / length)
    zeros = F.array_repeat(F.lit(0.0), len(model.tags))
    return F.when(length == 0.0, zeros).when(length.isNotNull() & F.get(products, F.lit(0)).isNotNull(), scaled)


def score_wide(
    df: DataFrame, model: TagModel, *, vector: str = "features", prefix: str = "sim_", engine: str = "arrow"
) -> DataFrame:
    """One ``sim_<tag>`` column per centroid, all from a single pass over the row."""
    sims = free_name(df, "sims")
    scored = df.withColumn(sims, similarities(raw_array_column(df, vector), model, engine))
    columns = {f"{prefix}{t}": F.get(sims, F.lit(i)) for i, t in enumerate(model.tags)}
    return scored.select(*df.columns, *[c.alias(name) for name, c in columns.items()])


def score_long(
    df: DataFrame,
    model: TagModel,
    *,
    keep: Sequence[str],
    vector: str = "features",
    where_split: tuple[str, str] | None = None,
    engine: str = "arrow",
) -> DataFrame:
    """One (row, tag, sim) per centroid: the row's score array, unrolled in place."""
    if where_split:
        name, value = where_split
        df = df.filter(F.col(name) == value)
    names = F.array(*[F.lit(t) for t in model.tags])
    sims, place = free_name(df, "sims"), free_name(df, "place")
    scored = df.select(*keep, similarities(raw_array_column(df, vector), model, engine).alias(sims))
    return scored.select(*keep, F.posexplode(sims).alias(place, "sim")).select(
        *keep, F.get(names, F.col(place)).alias("tag"), "sim"
    )


def pivot_wide(
    long: DataFrame, tags: Sequence[str], *, keys: Sequence[str], score: str = "sim", prefix: str = "sim_"
) -> DataFrame:
    """Long scores from a table back to wide; the tag list spares a scan for values."""
    ordered = sorted(tags)
    wide = long.groupBy(*keys).pivot("tag", ordered).agg(F.first(score, ignorenulls=True))
    return wide.select(*keys, *[F.col(f"`{t}`").alias(f"{prefix}{t}") for t in ordered])


def apply_thresholds(
    df: DataFrame,
    thresholds: Mapping[str, float],
    *,
    tags: Sequence[str] | None = None,
    sim: str = "sim_",
    pred: str = "pred_",
) -> DataFrame:
    """``pred_<tag>`` = 1 when the similarity reaches the threshold.

    A tag of ``tags`` that has no score or threshold gets 0.
    """
    predictions = {}
    for tag in tags if tags is not None else thresholds:
        if f"{sim}{tag}" in df.columns and tag in thresholds:
            hit = F.col(f"{sim}{tag}") >= F.lit(float(thresholds[tag]))
            predictions[f"{pred}{tag}"] = hit.cast("int")
        else:
            predictions[f"{pred}{tag}"] = F.lit(0)
    return df.withColumns(predictions)


def assigned_long(df: DataFrame, model: TagModel, *, keep: Sequence[str], vector: str = "features") -> DataFrame:
    """(row, tag, sim) for the tags whose threshold the row reaches."""
    limits = F.array(*[F.lit(float(model.thresholds.get(t, np.inf))) for t in model.tags])
    names = F.array(*[F.lit(t) for t in model.tags])
    sims, place = free_name(df, "sims"), free_name(df, "place")
    scored = df.select(*keep, similarities(raw_array_column(df, vector), model).alias(sims))
    return (
        scored.select(*keep, F.posexplode(sims).alias(place, "sim"))
        .filter(F.col("sim") >= F.get(limits, F.col(place)))
        .select(*keep, F.get(names, F.col(place)).alias("tag"), "sim")
    )


def tag_similarity_matrix(calibrated: DataFrame) -> DataFrame:
    """(tag_a, tag_b, sim) for all centroid pairs; its diagonal is 1."""
    model = TagModel.load(calibrated)
    rows = calibrated.select(F.col("tag").alias("tag_a"), "centroid")
    return score_long(rows, model, keep=["tag_a"], vector="centroid").withColumnRenamed("tag", "tag_b")
