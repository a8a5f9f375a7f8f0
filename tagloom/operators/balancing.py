"""Class balancing and numeric scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.keys import order_hash
from tagloom.operators.contracts import free_name
from tagloom.operators.joins import join_to_one
from tagloom.sources.storage import materialise

#: Leading hex digits of the order hash that a histogram is made of; 16**4 buckets a class.
CUT_DIGITS = 4


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, size) of the classes; rows without a class are none."""
    size = free_name(df, "size")
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias(size))


def class_cuts(df: DataFrame, label: str, extra: DataFrame, key: str, *, seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """(label, last): the seeded order hash of each class's row number ``n`` of ``extra`` (label, n), all classes in one pass.

    As ``sample_cut``: a histogram of hash buckets for each class finds the bucket
    that holds the row; only the hashes in those buckets are ranked. Classes with
    n = 0 or fewer than n rows have no row here.
    """
    rows = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("c"), order_hash(F.col(key), seed=seed, method=method).alias("h"))
    bucket = F.conv(F.substring("h", 1, CUT_DIGITS), 16, 10).cast("int")
    running = F.sum("n").over(Window.partitionBy("c").orderBy("bucket"))
    counted = rows.groupBy("c", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).withColumn("upto", running)
    wanted = extra.toDF("c", "wanted").filter("wanted > 0")
    cuts = (
        join_to_one(counted, wanted, "c").filter("upto >= wanted")
        .groupBy("c").agg(F.min_by(F.struct("bucket", (F.col("wanted") - F.col("upto") + F.col("n")).alias("left")), "bucket").alias("cut"))
        .select("c", "cut.bucket", "cut.left")
    )
    near = join_to_one(rows, cuts, "c").filter(bucket == F.col("bucket"))
    place = F.row_number().over(Window.partitionBy("c").orderBy("h"))
    last = near.withColumn("place", place).filter(F.col("place") == F.col("left"))
    return last.select(F.col("c").alias(label), F.col("h").alias("last"))


def _sized(df: DataFrame, label: str, sizes: DataFrame, wanted: Column, key: str, seed: int, method: str) -> DataFrame:
    """Every class of ``sizes`` brought to ``wanted`` rows, an expression over them; null leaves a class as it is.

    Each row stays ``wanted div size`` times, and those with the smallest order
    hashes once more until the size is met. Copies are made in place.
    """
    size = sizes.columns[1]
    plan = sizes.select(label, wanted.cast("bigint").alias("wanted"), F.col(size).alias("size")).filter("wanted IS NOT NULL")
    plan = materialise(plan.selectExpr(f"`{label}`", "wanted div size AS times", "wanted % size AS extra"), "classes")
    cuts = class_cuts(df, label, plan.select(label, "extra"), key, seed=seed, method=method)
    times, last, copy = (free_name(df, name) for name in ("times", "last", "copy"))
    full = plan.select(label, F.col("times").alias(times)).join(cuts.withColumnRenamed("last", last), label, "left")
    joined = join_to_one(df, materialise(full, "classes"), label, "left")
    more = F.coalesce(order_hash(F.col(key), seed=seed, method=method) <= F.col(last), F.lit(False))
    copies = F.when(F.col(times).isNull(), 1).otherwise(F.col(times).cast("int") + more.cast("int"))
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies))).select(*df.columns)


def resample(
    df: DataFrame, label: str, target: Mapping, key: str, *, seed: int = 42, method: str = "xxhash64"
) -> DataFrame:
    """Bring the classes named in ``target`` to exactly that many rows.

    Other classes and rows without a class keep their size; only a target of 0
    drops a class. A seeded hash of ``key`` decides which rows are kept or
    repeated once more than others, whatever the layout. Keys must be unique: rows
    that tie with the last one are kept together. Small tables of classes are
    written when the plan is made.
    """
    if not target:
        return df
    wanted = F.create_map(*[F.lit(x) for pair in target.items() for x in pair])
    return _sized(df, label, class_sizes(df, label), F.try_element_at(wanted, F.col(label)), key, seed, method)


def undersample(
    df: DataFrame, label: str, key: str, *, seed: int = 42, method: str = "xxhash64"
) -> DataFrame:
    """Every class cut to the size of the smallest; rows without a class stay."""
    sizes = class_sizes(df, label)
    return _sized(df, label, sizes, sizes.agg(F.min(sizes.columns[1])).scalar(), key, seed, method)


def oversample(
    df: DataFrame, label: str, key: str, *, seed: int = 42, method: str = "xxhash64"
) -> DataFrame:
    """Every class repeated to the size of the largest; rows without a class stay."""
    sizes = class_sizes(df, label)
    return _sized(df, label, sizes, sizes.agg(F.max(sizes.columns[1])).scalar(), key, seed, method)


def fit_min_max(train: DataFrame, columns: Sequence[str], out: str = "scaled") -> PipelineModel:
    """Min-max scaling of numeric columns, fitted on the given (train) rows only."""
    raw = free_name(train, "raw")
    gather = VectorAssembler(inputCols=list(columns), outputCol=raw, handleInvalid="skip")
    return Pipeline(stages=[gather, MinMaxScaler(inputCol=raw, outputCol=out)]).fit(train)
