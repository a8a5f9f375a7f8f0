"""Data-quality and label reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.bindings import (
    DOC_LABELS, GOLD_RECIPES_SQL, GOLD_REVIEWS_SQL, LABELLED_DOCUMENTS_SQL, RESOLVED_SQL,
    clean_documents, labelled_documents, labelled_vectors, raw_recipes, sql_clean,
)
from tagloom.catalog.ingesting import _gold_recipes, _gold_reviews
from tagloom.catalog.registry import query, table
from tagloom.catalog.vectors import resolved_vectors
from tagloom.functions.text import clean_token_count
from tagloom.operators import gold, reports
from tagloom.operators.cleaning import clean_recipes
from tagloom.operators.conflicts import conflict_counts
from tagloom.operators.labels import multi_hot, row_total, with_tag_list
from tagloom.operators.scoring import score_wide, apply_thresholds

TAG_COUNTS = "SELECT vec_id, CAST(sum(kept) AS INTEGER) AS total_tags FROM resolved GROUP BY vec_id"


def _multi_hot(spark, folder):
    return multi_hot(labelled_documents(spark, folder), DOC_LABELS, "labels")


@query(f"WITH {LABELLED_DOCUMENTS_SQL} SELECT split, count(*) AS n FROM labelled GROUP BY split")
def split_counts(spark, folder):
    return reports.counts_by(labelled_documents(spark, folder), "split")


@query(
    f"WITH {LABELLED_DOCUMENTS_SQL} SELECT doc_id, CAST(y_quality AS INTEGER) AS y_quality, "
    "CAST(y_toxic AS INTEGER) AS y_toxic, CAST(y_quality + y_toxic AS INTEGER) AS n FROM labelled"
)
def multi_hot_labels(spark, folder):
    rows = _multi_hot(spark, folder).select("doc_id", "y_quality", "y_toxic")
    return rows.withColumn("n", row_total(["y_quality", "y_toxic"]))


@query(
    f"WITH {LABELLED_DOCUMENTS_SQL} SELECT 'quality' AS label, round(avg(y_quality), 9) AS prevalence FROM labelled "
    "UNION ALL SELECT 'toxic', round(avg(y_toxic), 9) FROM labelled"
)
def label_prevalence(spark, folder):
    rows = reports.label_prevalence(_multi_hot(spark, folder), DOC_LABELS)
    return rows.withColumn("prevalence", F.round("prevalence", 9))


@query(
    f"WITH {LABELLED_DOCUMENTS_SQL} "
    "SELECT split, 'quality' AS label, round(avg(y_quality), 9) AS prevalence FROM labelled GROUP BY split "
    "UNION ALL SELECT split, 'toxic', round(avg(y_toxic), 9) FROM labelled GROUP BY split"
)
def prevalence_by_split(spark, folder):
    rows = reports.label_prevalence_by(_multi_hot(spark, folder), "split", DOC_LABELS)
    return rows.withColumn("prevalence", F.round("prevalence", 9))


@query(
    "SELECT event_type, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM events), 9) AS pct "
    "FROM events GROUP BY event_type"
)
def distribution_pct(spark, folder):
    rows = reports.distribution(table(spark, folder, "events"), "event_type")
    return rows.withColumn("pct", F.round("pct", 9))


@query("SELECT round(avg(CAST(l_quantity >= 4 AS INTEGER)) * 100, 9) AS pct FROM lineitem")
def liked_share(spark, folder):
    rows = reports.share_where(table(spark, folder, "lineitem"), F.col("l_quantity") >= 4)
    return rows.withColumn("pct", F.round("pct", 9))


@query(
    "SELECT l_suppkey, count(*) AS n_reviews, round(avg(l_quantity), 3) AS avg_rating, "
    "sum(CAST(l_quantity >= 4 AS INTEGER))::BIGINT AS n_liked FROM lineitem GROUP BY l_suppkey"
)
def entity_stats(spark, folder):
    rows = gold.with_liked(table(spark, folder, "lineitem"), "l_quantity")
    return reports.entity_stats(rows, ["l_suppkey"], "l_quantity")


@query(
    f"SELECT min(length({sql_clean('text')}))::INTEGER AS min_len, round(avg(length({sql_clean('text')})), 2) "
    f"AS avg_len, max(length({sql_clean('text')}))::INTEGER AS max_len FROM documents"
)
def length_summary(spark, folder):
    return reports.length_summary(clean_documents(spark, folder), "review_clean")


POINTS = (0.1, 0.25, 0.5, 0.75, 0.9)
POINTS_SQL = " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS p, quantile_disc(n, {p}) AS value FROM counted" for p in POINTS
)


@query(
    rf"WITH counted AS (SELECT CAST(len(regexp_split_to_array({sql_clean('text')}, '\s+')) AS INTEGER) AS n "
    f"FROM documents) {POINTS_SQL}"
)
def length_percentiles(spark, folder):
    tokens = clean_token_count(F.col("review_clean"))
    return reports.percentiles(clean_documents(spark, folder), tokens, POINTS)


@query(
    "SELECT 'name' AS \"column\", count(*) FILTER (WHERE p_partkey % 37 = 0) AS nulls FROM part "
    "UNION ALL SELECT 'minutes', count(*) FILTER (WHERE p_partkey % 17 = 0) FROM part "
    "UNION ALL SELECT 'ingredients_clean', count(*) FILTER (WHERE p_partkey % 13 = 0) FROM part "
    "UNION ALL SELECT 'carbs', count(*) FILTER (WHERE p_partkey % 11 = 0) FROM part"
)
def null_counts(spark, folder):
    rows = clean_recipes(raw_recipes(spark, folder))
    return reports.null_counts(rows, ["name", "minutes", "ingredients_clean", "carbs"])


@query(
    f"SELECT 'text' AS \"column\", count(*) FILTER (WHERE length(trim(text)) = 0) AS blanks FROM documents "
    f"UNION ALL SELECT 'review_clean', count(*) FILTER (WHERE length({sql_clean('text')}) = 0) FROM documents"
)
def blank_counts(spark, folder):
    return reports.blank_counts(clean_documents(spark, folder), ["text", "review_clean"])


@query(
    f"""
WITH {LABELLED_DOCUMENTS_SQL},
long AS (SELECT 'quality' AS tag FROM labelled WHERE y_quality = 1
         UNION ALL SELECT 'toxic' FROM labelled WHERE y_toxic = 1
         UNION ALL SELECT NULL FROM labelled WHERE y_quality + y_toxic = 0)
SELECT tag, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labelled), 9) AS pct FROM long GROUP BY tag"""
)
def label_report(spark, folder):
    rows = reports.label_report(labelled_documents(spark, folder), "labels")
    return rows.withColumn("pct", F.round("pct", 9))


@query(
    f"WITH {RESOLVED_SQL} SELECT tag, sum(kept)::BIGINT AS hits, "
    "round(sum(kept) * 100.0 / count(*), 9) AS pct FROM resolved GROUP BY tag"
)
def tag_totals(spark, folder):
    rows, model = resolved_vectors(spark, folder)
    return reports.tag_totals(rows, model.tags).withColumn("pct", F.round("pct", 9))


@query(f"WITH {RESOLVED_SQL}, per AS ({TAG_COUNTS}) SELECT total_tags, count(*) AS n FROM per GROUP BY total_tags")
def tag_density(spark, folder):
    return reports.tag_density(resolved_vectors(spark, folder)[0])


@query(f"WITH {RESOLVED_SQL}, per AS ({TAG_COUNTS}) SELECT round(avg(total_tags), 9) AS avg_tags FROM per")
def mean_tags(spark, folder):
    return reports.mean_tags(resolved_vectors(spark, folder)[0]).withColumn("avg_tags", F.round("avg_tags", 9))


@query(
    f"WITH {RESOLVED_SQL}, k AS (SELECT vec_id, tag FROM resolved WHERE kept = 1) "
    "SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n FROM k a JOIN k b USING (vec_id) GROUP BY ALL"
)
def cooccurrence(spark, folder):
    return reports.co_occurrence(resolved_vectors(spark, folder)[0])


@query(
    f"""
WITH {RESOLVED_SQL}
SELECT h.tag || '/' || pairs.other AS pair,
       (count(*) FILTER (WHERE h.hit = 1 AND o.hit = 1)) AS conflicts
FROM hits h JOIN pairs USING (tag) JOIN hits o ON o.vec_id = h.vec_id AND o.tag = pairs.other
WHERE positive GROUP BY ALL"""
)
def conflict_audit(spark, folder):
    """Contradictions before they are resolved."""
    rows, model = resolved_vectors(spark, folder)
    raw = apply_thresholds(score_wide(labelled_vectors(spark, folder), model), model.thresholds)
    return conflict_counts(raw)


@query(f"WITH {RESOLVED_SQL} SELECT tag || '/' || other AS pair, 0::BIGINT AS conflicts FROM pairs WHERE positive")
def conflicts_after(spark, folder):
    """Contradictions after they are resolved: none."""
    return conflict_counts(resolved_vectors(spark, folder)[0])


@query(
    f"WITH {GOLD_REVIEWS_SQL}, {GOLD_RECIPES_SQL}, wide AS (SELECT * FROM gold_reviews JOIN gold_recipes USING "
    "(recipe_id)) SELECT recipe_id, name, count(*) AS n_reviews, round(avg(rating), 3) AS avg_rating, "
    "sum(liked)::BIGINT AS n_liked FROM wide GROUP BY ALL"
)
def recipe_stats(spark, folder):
    wide = gold.gold_wide(_gold_reviews(spark, folder), _gold_recipes(spark, folder))
    return reports.entity_stats(wide, ["recipe_id", "name"])


@query(
    f"WITH {LABELLED_DOCUMENTS_SQL} SELECT doc_id, "
    "CASE WHEN y_quality = 1 AND y_toxic = 1 THEN 'quality,toxic' WHEN y_quality = 1 THEN 'quality' "
    "WHEN y_toxic = 1 THEN 'toxic' ELSE '' END AS tag_list, CAST(y_quality + y_toxic AS INTEGER) AS total_tags "
    "FROM labelled"
)
def tag_list(spark, folder):
    rows = with_tag_list(_multi_hot(spark, folder), DOC_LABELS, "y_")
    return rows.select("doc_id", F.array_join("tag_list", ",").alias("tag_list"), "total_tags")
