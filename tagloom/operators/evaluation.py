"""Confusion counts, threshold sweeps, benchmarks and agreement measures.

Scores are compared in long form (tag, label, score) so that all tags share one
pass. What comes out of the first aggregation is a few rows per tag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.metrics import ratio, with_metrics
from tagloom.operators.contracts import free_name

# The thresholds a sweep tries, 0.01 to 0.96 in steps of 0.05.
SWEEP = tuple(i / 100 for i in range(1, 100, 5))


def class_weights(df: DataFrame, labels: Sequence[str], prefix: str = "y_") -> DataFrame:
    """(label, pos_rate, w_pos, w_neg) giving both classes equal total weight.

    Weights are 1 where only one class occurs. All labels share one aggregation.
    """
    rates = df.agg(*[F.avg(F.col(f"{prefix}{t}").cast("double")).alias(t) for t in labels])
    long = rates.unpivot([], [f"`{t}`" for t in labels], "label", "rate")
    rate = F.coalesce(F.col("rate"), F.lit(0.0))
    mixed = (rate > 0) & (rate < 1)
    return long.select(
        "label",
        rate.alias("pos_rate"),
        F.when(mixed, 0.5 / rate).otherwise(1.0).alias("w_pos"),
        F.when(mixed, 0.5 / (1.0 - rate)).otherwise(1.0).alias("w_neg"),
    )


def with_class_weights(
    df: DataFrame, labels: Sequence[str], prefix: str = "y_", out: str = "w_"
) -> DataFrame:
    """One weight column per label; the weights are read once for all labels."""
    found = {r["label"]: r for r in class_weights(df, labels, prefix).collect()}
    return df.withColumns(
        {
            f"{out}{t}": F.when(F.col(f"{prefix}{t}") == 1, found[t]["w_pos"]).otherwise(found[t]["w_neg"])
            for t in labels
        }
    )


def _cells(y: Column, hit: Column) -> list[Column]:
    return [
        F.count_if((y == 1) & hit).alias("tp"),
        F.count_if((y == 0) & hit).alias("fp"),
        F.count_if((y == 0) & ~hit).alias("tn"),
        F.count_if((y == 1) & ~hit).alias("fn"),
    ]


def confusion_at(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row: confusion counts and metrics of ``score >= threshold``."""
    cells = df.agg(*_cells(F.col(label), F.col(score) >= F.lit(float(threshold))))
    return with_metrics(cells.select(F.lit(float(threshold)).alias("threshold"), "*"))


def confusion_by_tag(long: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """(tag, threshold, tp, fp, tn, fn, metrics) from (tag, y, score) rows, each
    tag at its own threshold."""
    limits = F.create_map(*[F.lit(x) for t, v in thresholds.items() for x in (t, float(v))])
    limit = limits[F.col("tag")]
    cells = long.groupBy("tag").agg(*_cells(F.col("y"), F.col("score") >= limit))
    return with_metrics(cells.select("tag", limit.alias("threshold"), "tp", "fp", "tn", "fn"))


def sweep(long: DataFrame, steps: Sequence[float] = SWEEP) -> DataFrame:
    """Confusion counts and metrics at every threshold for every tag.

    ``long`` holds (tag, y, score). One pass puts each row into the band between
    two thresholds; the counts at a threshold are sums over the bands above it,
    taken over at most ``len(steps) + 1`` rows per tag.
    """
    steps = sorted(float(s) for s in steps)
    band = reduce(add, [(F.col("score") >= s).cast("int") for s in steps])
    bands = long.groupBy("tag", band.alias("band")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    ladder = F.array(*[F.lit(s) for s in steps])
    rungs = bands.select("tag", "band", "pos", "neg", F.posexplode(ladder).alias("step", "threshold"))
    above = F.col("band") > F.col("step")

    def total(column: str, side: Column) -> Column:
        return F.sum(F.when(side, F.col(column)).otherwise(0))

    cells = rungs.groupBy("tag", "threshold").agg(
        total("pos", above).alias("tp"),
        total("neg", above).alias("fp"),
        total("neg", ~above).alias("tn"),
        total("pos", ~above).alias("fn"),
    )
    return with_metrics(cells)


def best_threshold(swept: DataFrame, objective: str = "f1") -> DataFrame:
    """Per tag the row with the highest objective; equal values take the lowest
    threshold."""
    fields = [c for c in swept.columns if c != "tag"]
    rank = F.struct(F.col(objective), -F.col("threshold"))
    return swept.groupBy("tag").agg(F.max_by(F.struct(*fields), rank).alias("best")).select("tag", "best.*")


def benchmark(
    df: DataFrame, tags: Sequence[str], *, truth: str = "y_", pred: str = "pred_"
) -> DataFrame:
    """(tag, tp, fp, fn, precision, recall, f1) of predicted against true columns."""
    cells = []
    for t in tags:
        y, p = F.col(f"{truth}{t}") == 1, F.col(f"{pred}{t}") == 1
        cells.append(
            F.struct(
                F.lit(t).alias("tag"),
                F.count_if(y & p).alias("tp"),
                F.count_if((F.col(f"{truth}{t}") == 0) & p).alias("fp"),
                F.count_if(y & (F.col(f"{pred}{t}") == 0)).alias("fn"),
            )
        )
    counted = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(cells)])
    long = counted.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cells))])))
    return with_metrics(long, with_negatives=False)


def macro_f1(benchmarked: DataFrame) -> DataFrame:
    return benchmarked.agg(F.avg("f1").alias("macro_f1"))


def long_scores(df: DataFrame, tags: Sequence[str], scores: Column, truth: str = "y_") -> DataFrame:
    """(tag, y, score) from 0/1 columns and an array of scores in tag order."""
    names = F.array(*[F.lit(t) for t in tags])
    truths = F.array(*[F.col(f"{truth}{t}") for t in tags])
    return df.select(truths.alias("_y"), scores.alias("_s")).select(
        F.inline(F.arrays_zip(names.alias("tag"), F.col("_y").alias("y"), F.col("_s").alias("score")))
    )


def roc_auc(long: DataFrame, by: Sequence[str] = ("tag",)) -> DataFrame:
    """(by..., positives, negatives, roc_auc) from rows with ``by``, ``y`` and ``score``: exact, all groups in one pass.

    The area is the share of (positive, negative) pairs in which the positive has
    the higher score, ties counting half. Rows of one score are counted together;
    scores are then sorted in ranges over all groups, so one group with most of
    the rows is spread like any other. Within a range negatives are summed up to
    each score, and an exclusive sum over the few ranges of a group adds those
    below. Rows without a score, or with labels other than 0 and 1, are left out;
    NaN is the highest score. Null where a class is missing.
    """
    by = list(by)
    y, score = F.col("y"), F.col("score").cast("double")
    counts = long.filter(y.isin(0, 1) & score.isNotNull()).groupBy(*by, score.alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    place = free_name(counts, "range")
    ranged = counts.repartitionByRange(*by, "score").withColumn(place, F.spark_partition_id())
    inside = Window.partitionBy(*by, place).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("neg") / 2
    parts = ranged.withColumn("won", F.col("pos") * below).groupBy(*by, place).agg(
        F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    before = Window.partitionBy(*by).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("pos") * F.coalesce(F.sum("neg").over(before), F.lit(0))
    found = parts.withColumn("won", F.col("won") + lower).groupBy(*by).agg(
        F.sum("won").alias("won"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return found.select(*by, "positives", "negatives", F.try_divide(F.col("won"), pairs).alias("roc_auc"))


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """One row: confusion metrics plus accuracy and exact ROC-AUC, null where a class is missing. Lazy."""
    report = confusion_at(df, label, score, threshold)
    ranked = roc_auc(df.select(F.lit("all").alias("tag"), F.col(label).alias("y"), F.col(score).alias("score")))
    total = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    accuracy = ratio(F.col("tp") + F.col("tn"), total)
    return report.withColumns({"accuracy": accuracy, "roc_auc": ranked.select("roc_auc").scalar()})


def quadratic_kappa(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Cohen's kappa with squared-distance weights, from the joint counts.

    sum (a - p)^2 over pairs, against its expectation under independence, needs
    only first and second moments, so a single aggregation suffices.
    """
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    m = df.filter(a.isNotNull() & p.isNotNull()).agg(
        F.avg((a - p) * (a - p)).alias("observed"),
        F.avg(a).alias("ma"), F.avg(p).alias("mp"),
        F.avg(a * a).alias("qa"), F.avg(p * p).alias("qp"),
    )
    expected = F.col("qa") + F.col("qp") - 2 * F.col("ma") * F.col("mp")
    return m.select(F.coalesce(1 - F.try_divide(F.col("observed"), expected), F.lit(1.0)).alias("kappa"))


def regression_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: mse, rmse, mae, r2."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    m = df.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(y).alias("variance"))
    return m.select(
        "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide(F.col("mse"), F.col("variance"))).alias("r2")
    )
