"""Weights, confusion counts, sweeps, benchmarks and agreement measures."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tagloom.catalog.bindings import (
    CALIBRATION_SQL, DOC_LABELS, LABELLED_DOCUMENTS_SQL, RESOLVED_SQL, labelled_vectors, sql_unit_hash,
)
from tagloom.catalog.registry import query, table
from tagloom.catalog.reporting import _multi_hot
from tagloom.catalog.vectors import calibrated
from tagloom.operators import evaluation
from tagloom.operators.balancing import fit_min_max, resample, oversample, undersample
from tagloom.operators.labels import multi_hot
from tagloom.operators.splits import assign_splits
from tagloom.operators.scoring import TagModel, similarities
from tagloom.functions.vectors import raw_array_column
from tagloom.plans.tagging import benchmark_labelled

METRICS = ("precision", "recall", "f1", "fpr", "youden_j")


def sql_metrics(source: str) -> str:
    """Metric formulas restated on a CTE with tp, fp, tn, fn."""
    p = "CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END"
    r = "CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END"
    x = "CASE WHEN fp + tn > 0 THEN fp / (fp + tn)::DOUBLE ELSE 0 END"
    return (
        f"SELECT * EXCLUDE (p, r, x), round(p, 9) AS precision, round(r, 9) AS recall, "
        "round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1, "
        "round(x, 9) AS fpr, round(r - x, 9) AS youden_j "
        f"FROM (SELECT *, {p} AS p, {r} AS r, {x} AS x FROM {source})"
    )


def _rounded(df, columns=METRICS):
    return df.withColumns({c: F.round(c, 9) for c in columns if c in df.columns})


CELLS = """
count(*) FILTER (WHERE y = 1 AND hit) AS tp, count(*) FILTER (WHERE y = 0 AND hit) AS fp,
count(*) FILTER (WHERE y = 0 AND NOT hit) AS tn, count(*) FILTER (WHERE y = 1 AND NOT hit) AS fn"""


def _scores_long(spark, folder):
    """(tag, y, score): each vector against each centroid, own class true."""
    model = TagModel.load(calibrated(spark, folder))
    rows = multi_hot(labelled_vectors(spark, folder), model.tags, "tags")
    return evaluation.long_scores(rows, model.tags, similarities(raw_array_column(rows, "features"), model))


@query(
    f"WITH {LABELLED_DOCUMENTS_SQL}, rates AS (SELECT 'quality' AS label, avg(y_quality) AS r FROM labelled "
    "UNION ALL SELECT 'toxic', avg(y_toxic) FROM labelled) "
    "SELECT label, round(r, 9) AS pos_rate, round(0.5 / r, 6) AS w_pos, round(0.5 / (1 - r), 6) AS w_neg FROM rates"
)
def class_weights(spark, folder):
    rows = evaluation.class_weights(_multi_hot(spark, folder), DOC_LABELS)
    return rows.select(
        "label", F.round("pos_rate", 9).alias("pos_rate"), F.round("w_pos", 6).alias("w_pos"),
        F.round("w_neg", 6).alias("w_neg"),
    )


@query(
    f"WITH {LABELLED_DOCUMENTS_SQL}, r AS (SELECT avg(y_toxic) AS r FROM labelled) "
    "SELECT doc_id, round(CASE WHEN y_toxic = 1 THEN 0.5 / r.r ELSE 0.5 / (1 - r.r) END, 6) AS w_toxic "
    "FROM labelled, r"
)
def row_weights(spark, folder):
    rows = evaluation.with_class_weights(_multi_hot(spark, folder), ["toxic"])
    return rows.select("doc_id", F.round("w_toxic", 6).alias("w_toxic"))


@query(
    f"WITH cells AS (SELECT 0.5::DOUBLE AS threshold, {CELLS} FROM (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, "
    f"l_discount * 10 >= 0.5 AS hit FROM lineitem)) {sql_metrics('cells')}"
)
def confusion_at_threshold(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 10).alias("score")
    )
    return _rounded(evaluation.confusion_at(rows, "y", "score", 0.5))


STEPS_SQL = ", ".join(f"({s}::DOUBLE)" for s in evaluation.SWEEP)
SWEEP_SQL = f"""{CALIBRATION_SQL},
steps(threshold) AS (VALUES {STEPS_SQL}),
swept AS (
  SELECT tag, threshold, {CELLS}
  FROM (SELECT tag, threshold, CAST(own = tag AS INTEGER) AS y, sim >= threshold AS hit FROM scores, steps)
  GROUP BY tag, threshold
),
measured AS ({sql_metrics('swept')})"""


@query(f"WITH {SWEEP_SQL} SELECT * FROM measured")
def threshold_sweep(spark, folder):
    return _rounded(evaluation.sweep(_scores_long(spark, folder)))


@query(
    f"WITH {SWEEP_SQL} SELECT * EXCLUDE (rn) FROM (SELECT *, "
    "row_number() OVER (PARTITION BY tag ORDER BY f1 DESC, threshold) AS rn FROM measured) WHERE rn = 1"
)
def best_thresholds(spark, folder):
    return _rounded(evaluation.best_threshold(evaluation.sweep(_scores_long(spark, folder))))


@query(
    f"WITH {CALIBRATION_SQL}, swept AS (SELECT 0.84::DOUBLE AS threshold, {CELLS} FROM (SELECT "
    f"CAST(own = 'dry' AS INTEGER) AS y, sim >= 0.84 AS hit FROM scores WHERE tag = 'dry')) {sql_metrics('swept')}"
)
def hardened_threshold(spark, folder):
    """One tag at a stricter threshold than the calibrated one."""
    rows = _scores_long(spark, folder).filter(F.col("tag") == "dry")
    return _rounded(evaluation.confusion_at(rows, "y", "score", 0.84))


BENCHMARK_SQL = f"""{RESOLVED_SQL},
cells AS (
  SELECT tag, {CELLS} FROM (SELECT tag, CAST(own = tag AS INTEGER) AS y, kept = 1 AS hit FROM resolved) GROUP BY tag
),
measured AS (SELECT * EXCLUDE (tn, fpr, youden_j) FROM ({sql_metrics('cells')}))"""


@query(f"WITH {BENCHMARK_SQL} SELECT * FROM measured")
def multi_tag_benchmark(spark, folder):
    model = TagModel.load(calibrated(spark, folder))
    return _rounded(benchmark_labelled(labelled_vectors(spark, folder), model, labels="tags"))


@query(f"WITH {BENCHMARK_SQL} SELECT round(avg(f1), 6) AS macro_f1 FROM measured")
def macro_f1(spark, folder):
    model = TagModel.load(calibrated(spark, folder))
    rows = evaluation.macro_f1(benchmark_labelled(labelled_vectors(spark, folder), model, labels="tags"))
    return rows.withColumn("macro_f1", F.round("macro_f1", 6))


@query(
    """
WITH r AS (SELECT l_linenumber AS a, CAST(l_quantity % 7 AS INTEGER) + 1 AS p FROM lineitem),
o AS (SELECT a, p, count(*)::DOUBLE AS n FROM r GROUP BY a, p),
ma AS (SELECT a, sum(n) AS n FROM o GROUP BY a), mp AS (SELECT p, sum(n) AS n FROM o GROUP BY p),
t AS (SELECT sum(n) AS n FROM o)
SELECT round(1 - (SELECT sum(n * (a - p) * (a - p)) FROM o)
               / (SELECT sum(ma.n * mp.n / t.n * (a - p) * (a - p)) FROM ma, mp, t), 9) AS kappa"""
)
def quadratic_kappa(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("a"), ((F.col("l_quantity") % 7).cast("int") + 1).alias("p")
    )
    return evaluation.quadratic_kappa(rows, "a", "p").withColumn("kappa", F.round("kappa", 9))


@query(
    """
WITH r AS (SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)
SELECT round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(avg(abs(y - p)), 4) AS mae, round(1 - avg((y - p) * (y - p)) / var_pop(y), 9) AS r2 FROM r"""
)
def regression_report(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("p")
    )
    places = {"mse": 2, "rmse": 4, "mae": 4, "r2": 9}
    report = evaluation.regression_report(rows, "y", "p")
    return report.withColumns({c: F.round(c, n) for c, n in places.items()})


@query(
    f"""
WITH r AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount * 10 AS s FROM lineitem),
cells AS (SELECT 0.5::DOUBLE AS threshold, {CELLS} FROM (SELECT y, s >= 0.5 AS hit FROM r)),
ranked AS (SELECT s, sum(y) AS pos, count(*) - sum(y) AS neg FROM r GROUP BY s),
auc AS (
  SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc
  FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM ranked))
SELECT m.*, round((tp + tn) / (tp + tn + fp + fn)::DOUBLE, 9) AS accuracy, round((SELECT auc FROM auc), 9) AS roc_auc
FROM ({sql_metrics('cells')}) m"""
)
def classification_report(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") * 10).alias("score")
    )
    return _rounded(evaluation.classification_report(rows, "y", "score"), (*METRICS, "accuracy", "roc_auc"))


@query(
    f"""
WITH {CALIBRATION_SQL}, rows AS (
  SELECT tag, CAST(own = tag AS INTEGER) AS y, sim AS s FROM scores
  UNION ALL SELECT 'discount of returned', CAST(l_returnflag = 'R' AS INTEGER), l_discount::DOUBLE FROM lineitem),
ranked AS (SELECT tag, y, rank() OVER (PARTITION BY tag ORDER BY s) + (count(*) OVER (PARTITION BY tag, s) - 1) / 2.0 AS place FROM rows)
SELECT tag, sum(y)::BIGINT AS positives, (count(*) - sum(y))::BIGINT AS negatives,
       round((sum(y * place) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y)::DOUBLE * (count(*) - sum(y))), 9) AS roc_auc
FROM ranked GROUP BY tag"""
)
def auc_by_tag(spark, folder):
    """Exact areas of all tags in one pass, with a group of few different scores among them."""
    returned = table(spark, folder, "lineitem").select(
        F.lit("discount of returned").alias("tag"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_discount").cast("double").alias("score"),
    )
    found = evaluation.roc_auc(_scores_long(spark, folder).unionByName(returned))
    return found.withColumn("roc_auc", F.round("roc_auc", 9))


@query(
    f"WITH r AS (SELECT o_orderkey, o_totalprice AS v, {sql_unit_hash('o_orderkey')} < 0.8 AS fit FROM orders), "
    "b AS (SELECT min(v) AS lo, max(v) AS hi FROM r WHERE fit) "
    "SELECT o_orderkey, round((v - lo) / (hi - lo), 6) AS scaled FROM r, b"
)
def minmax_scale(spark, folder):
    """Scaling fitted on the train rows, applied to all."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    train = assign_splits(orders, "o_orderkey", method="md5").filter(F.col("split") == "train")
    scaled = fit_min_max(train, ["o_totalprice"]).transform(orders)
    value = F.get(vector_to_array("scaled"), F.lit(0))
    return scaled.select("o_orderkey", F.round(value, 6).alias("scaled"))


def sql_balanced(pick: str) -> str:
    """Rows of each class repeated to exactly the size of the smallest or largest class."""
    return f"""
WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42::' || o_orderkey)) AS place,
                  count(*) OVER (PARTITION BY o_orderstatus) AS m FROM orders),
want AS (SELECT {pick}(m) AS n FROM r),
copies AS (SELECT o_orderkey, o_orderstatus, n // m + CAST(place <= n % m AS INTEGER) AS k FROM r, want)
SELECT o_orderkey, o_orderstatus FROM (SELECT o_orderkey, o_orderstatus, unnest(range(k)) FROM copies)"""


@query(sql_balanced("min"))
def undersample_majority(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return undersample(orders, "o_orderstatus", "o_orderkey", method="md5")


@query(sql_balanced("max"))
def oversample_minority(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return oversample(orders, "o_orderstatus", "o_orderkey", method="md5")


@query(
    """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS stars FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY stars ORDER BY md5('42::' || o_orderkey)) AS place, count(*) OVER (PARTITION BY stars) AS m FROM s),
want(stars, n) AS (VALUES (1, 500), (2, 4000), (3, 1000), (4, 6000)),
copies AS (SELECT o_orderkey, r.stars, CASE WHEN n IS NULL THEN 1 ELSE n // m + CAST(place <= n % m AS INTEGER) END AS k FROM r LEFT JOIN want USING (stars))
SELECT o_orderkey, stars, count(*) AS n FROM (SELECT o_orderkey, stars, unnest(range(k)) FROM copies) GROUP BY ALL"""
)
def ordinal_resample(spark, folder):
    """Star classes 1 to 4 brought to exactly the chosen sizes; class 5 and rows without stars stay as they are."""
    stars = F.when(F.col("o_orderkey") % 11 != 0, F.substring("o_orderpriority", 1, 1).cast("int"))
    orders = table(spark, folder, "orders").select("o_orderkey", stars.alias("stars"))
    out = resample(orders, "stars", {1: 500, 2: 4000, 3: 1000, 4: 6000}, "o_orderkey", method="md5")
    return out.groupBy("o_orderkey", "stars").agg(F.count(F.lit(1)).alias("n"))
