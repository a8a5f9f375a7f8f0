"""Tag centroids, calibrated thresholds, and centroid comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.vectors import array_column, cosine, dot, raw_array_column, unit
from tagloom.operators.contracts import require_columns, unrolled
from tagloom.operators.joins import join_to_one


def usable_vectors(df: DataFrame, vector: str = "features", size: int | None = None, *, refused: bool = False) -> DataFrame:
    """Rows whose vector is there, holds no null, and has ``size`` elements; with ``refused`` all others.

    Without ``size`` the commonest length counts, the shorter of equal ones.
    """
    values = raw_array_column(df, vector)
    length = F.lit(size)
    if size is None:
        lengths = df.filter(F.col(vector).isNotNull()).groupBy(F.size(values).alias("length")).count()
        length = lengths.agg(F.max_by("length", F.struct("count", -F.col("length")))).scalar()
    whole = values.isNotNull() & (F.size(values) == length) & ~F.exists(values, lambda x: x.isNull())
    whole = F.coalesce(whole, F.lit(False))
    return df.filter(~whole if refused else whole)


def calibrate(
    labelled: DataFrame,
    *,
    tags: str = "tags",
    vector: str = "features",
    split: str | None = "split",
    centroid_split: str = "train",
    threshold_split: str | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """(tag, pos_count, centroid, threshold) from rows carrying an array of tags.

    The centroid is the mean of a tag's vectors. The threshold is the mean cosine
    of its rows to that centroid. Since cos(x, c) = unit(x) . unit(c), that mean
    equals mean(unit(x)) . unit(c), so both come from **one** pass and one
    aggregation whose shuffle holds two vectors per tag and task: no second scan,
    no join back to the centroids, and no tag is too big for it.

    A tag without positives has no row. ``split=None`` uses every row; ``only``
    restricts the tags. Vectors that ``usable_vectors`` refuses are left out.
    """
    require_columns(labelled, [tags, vector, *([split] if split else [])], "calibrate")
    labelled = usable_vectors(labelled, vector)
    is_vector = isinstance(labelled.schema[vector].dataType, VectorUDT)
    as_vector = F.col(vector) if is_vector else array_to_vector(F.col(vector).cast("array<double>"))
    threshold_split = threshold_split or centroid_split
    wanted = F.array_distinct(F.col(tags))
    if only is not None:
        wanted = F.array_intersect(wanted, F.array(*[F.lit(t) for t in only]))
    rows = labelled.filter(F.col(vector).isNotNull())
    if split:
        rows = rows.filter(F.col(split).isin(centroid_split, threshold_split))
    rows = rows.select(
        F.col(split).alias("split") if split else F.lit(centroid_split).alias("split"),
        as_vector.alias("x"),
        wanted.alias("tags"),
    )
    rows = Normalizer(inputCol="x", outputCol="x_unit").transform(rows)
    long = unrolled(rows, ["split", "x", "x_unit"], "tags", "tag")
    shares = long.groupBy("tag", "split").agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.mean(F.col("x"))).alias("mean"),
        vector_to_array(Summarizer.mean(F.col("x_unit"))).alias("mean_unit"),
    )
    # At most two rows per tag from here on.
    fit = shares.filter(F.col("split") == centroid_split).select(
        "tag", F.col("n").alias("pos_count"), F.col("mean").alias("centroid"), "mean_unit"
    )
    if threshold_split != centroid_split:
        held = shares.filter(F.col("split") == threshold_split).select("tag", "mean_unit")
        fit = fit.drop("mean_unit").join(held, "tag", "left")
    return fit.select(
        "tag",
        "pos_count",
        "centroid",
        dot(F.col("mean_unit"), unit(F.col("centroid"))).alias("threshold"),
    )


def own_centroid_similarity(
    long: DataFrame, centroids: DataFrame, *, vector: str = "features", tag: str = "tag"
) -> DataFrame:
    """Cosine of each (row, tag) to the centroid of that tag; adds ``sim``.

    Row-level form of what ``calibrate`` averages. Centroids are joined by tag;
    Spark broadcasts them where its threshold allows.
    """
    own = centroids.select(F.col("tag").alias(tag), F.col("centroid").alias("_centroid"))
    joined = join_to_one(long, own, tag)
    return joined.withColumn("sim", cosine(array_column(joined, vector), F.col("_centroid"))).drop("_centroid")


def centroid_drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(tag, stability, identical) between two runs, least stable first."""
    then = previous.select("tag", F.col("centroid").alias("old"))
    both = current.select("tag", "centroid").join(then, "tag")
    now, old = array_column(both, "centroid"), array_column(both, "old")
    return both.select(
        "tag", cosine(now, old).alias("stability"), (now == old).alias("identical")
    ).orderBy("stability", "tag")


def vectors_differ(current: DataFrame, previous: DataFrame, tag: str) -> bool:
    """Whether a tag's centroid changed between runs; raises if either lacks it."""
    found = []
    for label, frame in (("current", current), ("previous", previous)):
        row = frame.filter(F.col("tag") == tag).select("centroid").first()
        if row is None or row["centroid"] is None:
            raise ValueError(f"Tag {tag!r} has no centroid in the {label} run")
        found.append(list(row["centroid"]))
    return found[0] != found[1]
