"""Centroids, thresholds, similarity scores and resolved tags over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.bindings import CALIBRATION_SQL, CLASS_TAGS, RESOLVED_SQL, VECTORS_SQL, labelled_vectors
from tagloom.catalog.registry import query
from tagloom.operators import centroids, scoring
from tagloom.operators.conflicts import resolve_conflicts
from tagloom.operators.scoring import TagModel
from tagloom.plans.tagging import tag
from tagloom.sources import runs
from tagloom.sources.storage import materialise, scratch_path

PLACES = 6


def calibrated(spark, folder):
    return centroids.calibrate(labelled_vectors(spark, folder))


def resolved_vectors(spark, folder):
    """Every vector scored, thresholded and resolved; and the model used."""
    model = TagModel.load(calibrated(spark, folder))
    return tag(labelled_vectors(spark, folder), model, keep=["vec_id", "tag", "split"]), model


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, PLACES) for c in columns})


@query(f"WITH {CALIBRATION_SQL} SELECT tag, CAST(i - 1 AS INTEGER) AS i, round(value, {PLACES}) AS value FROM elements")
def tag_centroids(spark, folder):
    rows = calibrated(spark, folder).select("tag", F.posexplode("centroid").alias("i", "value"))
    return _rounded(rows, "value")


@query(f"WITH {CALIBRATION_SQL} SELECT tag, pos_count, round(threshold, {PLACES}) AS threshold FROM thresholds")
def diagonal_thresholds(spark, folder):
    return _rounded(calibrated(spark, folder).select("tag", "pos_count", "threshold"), "threshold")


@query(
    f"WITH {CALIBRATION_SQL} SELECT v.tag, round(avg(list_cosine_similarity(x, c)), {PLACES}) AS threshold "
    "FROM vectors v JOIN centroids USING (tag) WHERE split = 'val' GROUP BY v.tag"
)
def held_out_thresholds(spark, folder):
    """Centroids from train, thresholds from val."""
    rows = centroids.calibrate(labelled_vectors(spark, folder), threshold_split="val")
    return _rounded(rows.filter(F.col("threshold").isNotNull()).select("tag", "threshold"), "threshold")


@query(
    f"WITH {CALIBRATION_SQL} SELECT vec_id, v.tag, round(list_cosine_similarity(x, c), {PLACES}) AS sim "
    "FROM vectors v JOIN centroids USING (tag)"
)
def own_centroid_similarity(spark, folder):
    rows = labelled_vectors(spark, folder).select("vec_id", "tag", "features")
    scored = centroids.own_centroid_similarity(rows, calibrated(spark, folder))
    return _rounded(scored.select("vec_id", "tag", "sim"), "sim")


@query(f"WITH {CALIBRATION_SQL} SELECT vec_id, split, tag, round(sim, {PLACES}) AS sim FROM scores")
def similarity_long(spark, folder):
    model = TagModel.load(calibrated(spark, folder))
    return _rounded(scoring.score_long(labelled_vectors(spark, folder), model, keep=["vec_id", "split"]), "sim")


@query(f"WITH {CALIBRATION_SQL} SELECT vec_id, split, tag, round(sim, {PLACES}) AS sim FROM scores WHERE split = 'test'")
def similarity_test_split(spark, folder):
    model = TagModel.load(calibrated(spark, folder))
    rows = scoring.score_long(
        labelled_vectors(spark, folder), model, keep=["vec_id", "split"], where_split=("split", "test")
    )
    return _rounded(rows, "sim")


WIDE_SQL = ", ".join(f"round(max(sim) FILTER (WHERE tag = '{t}'), {PLACES}) AS sim_{t}" for t in CLASS_TAGS)


@query(f"WITH {CALIBRATION_SQL} SELECT vec_id, {WIDE_SQL} FROM scores GROUP BY vec_id")
def similarity_wide(spark, folder):
    model = TagModel.load(calibrated(spark, folder))
    wide = scoring.score_wide(labelled_vectors(spark, folder).select("vec_id", "features"), model).drop("features")
    return _rounded(wide, *wide.columns[1:])


@query(f"WITH {CALIBRATION_SQL} SELECT vec_id, {WIDE_SQL} FROM scores GROUP BY vec_id")
def similarity_wide_native(spark, folder):
    """The same scores without leaving the JVM."""
    model = TagModel.load(calibrated(spark, folder))
    rows = labelled_vectors(spark, folder).select("vec_id", "features")
    wide = scoring.score_wide(rows, model, engine="native").drop("features")
    return _rounded(wide, *wide.columns[1:])


@query(f"WITH {CALIBRATION_SQL} SELECT vec_id, {WIDE_SQL} FROM scores GROUP BY vec_id")
def similarity_pivot(spark, folder):
    """Long scores turned wide by key."""
    model = TagModel.load(calibrated(spark, folder))
    long = scoring.score_long(labelled_vectors(spark, folder), model, keep=["vec_id"])
    wide = scoring.pivot_wide(long, CLASS_TAGS, keys=["vec_id"])
    return _rounded(wide, *wide.columns[1:])


@query(f"WITH {CALIBRATION_SQL} SELECT vec_id, tag, round(sim, {PLACES}) AS sim FROM hits WHERE hit = 1")
def threshold_assign(spark, folder):
    model = TagModel.load(calibrated(spark, folder))
    return _rounded(scoring.assigned_long(labelled_vectors(spark, folder), model, keep=["vec_id"]), "sim")


@query(
    f"""
WITH {RESOLVED_SQL}
SELECT vec_id, coalesce(string_agg(tag, ',' ORDER BY tag) FILTER (WHERE kept = 1), '') AS tag_list,
       CAST(sum(kept) AS INTEGER) AS total_tags
FROM resolved GROUP BY vec_id"""
)
def tag_vectors(spark, folder):
    """Flagship: calibrate on train, score everything, threshold, resolve."""
    rows, _ = resolved_vectors(spark, folder)
    return rows.select("vec_id", F.array_join(F.array_sort("tag_list"), ",").alias("tag_list"), "total_tags")


PRED_SQL = ", ".join(f"CAST(max(kept) FILTER (WHERE tag = '{t}') AS INTEGER) AS pred_{t}" for t in CLASS_TAGS)


@query(f"WITH {RESOLVED_SQL} SELECT vec_id, {PRED_SQL} FROM resolved GROUP BY vec_id")
def resolved_predictions(spark, folder):
    model = TagModel.load(calibrated(spark, folder))
    scored = scoring.score_wide(labelled_vectors(spark, folder), model)
    resolved = resolve_conflicts(scoring.apply_thresholds(scored, model.thresholds, tags=CLASS_TAGS))
    return resolved.select("vec_id", *[f"pred_{t}" for t in CLASS_TAGS])


HALVES_SQL = f"""{VECTORS_SQL},
halves AS (
  SELECT half, tag, list(value ORDER BY i) AS c FROM (
    SELECT vec_id % 2 AS half, tag, i, avg(x[i]) AS value
    FROM (SELECT vec_id, tag, x, unnest(range(1, len(x) + 1)) AS i FROM vectors) GROUP BY ALL)
  GROUP BY ALL
)"""


@query(
    f"WITH {HALVES_SQL} SELECT a.tag, round(list_cosine_similarity(a.c, b.c), {PLACES}) AS stability, "
    "FALSE AS identical FROM halves a JOIN halves b USING (tag) WHERE a.half = 0 AND b.half = 1"
)
def centroid_drift(spark, folder):
    """Centroids of two halves of the data compared tag by tag."""
    rows = labelled_vectors(spark, folder)
    one, two = [
        centroids.calibrate(rows.filter(F.col("vec_id") % 2 == half), split=None) for half in (0, 1)
    ]
    return _rounded(centroids.centroid_drift(one, two), "stability")


@query(
    f"WITH {CALIBRATION_SQL} SELECT a.tag AS tag_a, b.tag AS tag_b, "
    f"round(list_cosine_similarity(a.c, b.c), {PLACES}) AS sim FROM centroids a CROSS JOIN centroids b"
)
def tag_similarity_matrix(spark, folder):
    return _rounded(scoring.tag_similarity_matrix(calibrated(spark, folder)), "sim")


@query(
    f"WITH {CALIBRATION_SQL} SELECT 'tag_threshold' AS name, tag, round(threshold, {PLACES}) AS value FROM thresholds"
)
def run_metrics(spark, folder):
    """Thresholds stored as metric rows of a registered run and read back from
    the newest run."""
    base = scratch_path(spark, "runs")
    run_id = runs.new_run_id()
    table = materialise(calibrated(spark, folder), "centroids")
    rows = table.select(F.lit("tag_threshold").alias("name"), "tag", F.col("threshold").alias("value"))
    runs.append_metrics(rows, base, run_id)
    runs.register_run(spark, base, run_id, outputs=[f"{base}/metrics"])
    newest, _ = runs.latest_runs(spark, base)[0]
    return _rounded(runs.read_metrics(spark, base, newest, "tag_threshold").select("name", "tag", "value"), "value")
