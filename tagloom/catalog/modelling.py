"""Trained models over the supplied tables. What is learned depends on training, so
these return what must hold whatever is learned, next to the SQL that states it."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tagloom.catalog.bindings import (
    CALIBRATION_SQL, CLASS_TAGS, CORPUS_TAXONOMY, VECTORS_SQL, WEAK_CONFIG, WEAK_LABELS_SQL, clean_documents,
    labelled_vectors, sql_split, sql_strings, sql_unit_hash,
)
from tagloom.catalog.evaluating import CELLS, METRICS, STEPS_SQL, sql_metrics
from tagloom.catalog.registry import query, table
from tagloom.catalog.texts import SQL_TOKENS
from tagloom.operators.centroids import calibrate, usable_vectors
from tagloom.operators.gold import attach_by_key, with_review_key
from tagloom.operators.labels import multi_hot, tags_set
from tagloom.operators.text_features import (
    TextSpec, Word2VecSpec, embed, fit_word2vec, nearest_words, token_stages, top_terms,
)
from tagloom.operators.taxonomy import NEGATION_PAIRS
from tagloom.operators.training import Weights, evaluate_per_tag, fit_per_tag, grid_search, mean_areas
from tagloom.operators.weak_labels import label
from tagloom.plans import features as feature_plan
from tagloom.plans.tagging import recalibrate, tag_corpus
from tagloom.plans.training import train_and_evaluate
from tagloom.sources.storage import materialise, scratch_path, write_table

# The design's vectors for a corpus: full width and iterations.
VECTORS = Word2VecSpec(size=128)


def _tokens(spark, folder):
    docs = clean_documents(spark, folder).select("doc_id", "review_clean")
    terms = token_stages(TextSpec()).fit(docs).transform(docs)
    return materialise(terms.select("doc_id", "tokens_all"), "tokens")


@query(f"WITH {SQL_TOKENS} SELECT doc_id, 128 AS dims, len(kept) = 0 AS tokenless FROM kept")
def word2vec_embed(spark, folder):
    """Vectors depend on training; their width does not, and rows without tokens have zeros."""
    tokens = _tokens(spark, folder)
    embedded = embed(tokens, fit_word2vec(tokens, VECTORS, key="doc_id"))
    values = vector_to_array("review_embeddings")
    blank = (F.size("tokens_all") == 0) & ~F.exists(values, lambda x: x != 0)
    return embedded.select("doc_id", F.size(values).alias("dims"), blank.alias("tokenless"))


@query("SELECT 5::BIGINT AS n, false AS itself, true AS bounded")
def word2vec_neighbours(spark, folder):
    """Five neighbours of the commonest word, scored over the table of trained vectors."""
    tokens = _tokens(spark, folder)
    word = top_terms(tokens, "tokens_all", 1).first()["term"]
    found = nearest_words(fit_word2vec(tokens, VECTORS, key="doc_id").getVectors(), word, 5)
    return found.agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("word") == word).alias("itself"),
        F.bool_and(F.abs("similarity") <= 1.0).alias("bounded"),
    )


@query(
    f"""WITH {VECTORS_SQL}, tags AS (SELECT unnest({sql_strings(CLASS_TAGS)}) AS tag)
SELECT t.tag, count(*) FILTER (WHERE v.tag = t.tag) AS positives, count(*) AS n, true AS valid
FROM tags t, vectors v WHERE split = 'test' GROUP BY t.tag"""
)
def logistic_per_tag(spark, folder):
    """A classifier for every class tag. Weights depend on training; test positives and sizes do not."""
    rows = labelled_vectors(spark, folder).withColumn("features", array_to_vector(F.col("features").cast("array<double>")))
    truths = [f"y_{t}" for t in CLASS_TAGS]
    rows = materialise(multi_hot(rows, CLASS_TAGS, "tags").select("split", "features", *truths), "dataset")
    part = {s: rows.filter(F.col("split") == s) for s in ("train", "val", "test")}
    return _facts(evaluate_per_tag(part["val"], part["test"], fit_per_tag(part["train"], CLASS_TAGS)))


def _facts(report):
    """What holds of a report whatever was learned."""
    return report.select(
        "tag", (F.col("tp") + F.col("fn")).alias("positives"), (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"),
        F.col("f1").between(0.0, 1.0).alias("valid"),
    )


def _dry(spark, folder):
    """Vectors with a label that a classifier learns."""
    rows = labelled_vectors(spark, folder).select(
        "vec_id", (F.col("tag") == "dry").cast("int").alias("label"),
        array_to_vector(F.col("features").cast("array<double>")).alias("features"),
    )
    return materialise(rows, "grid")


FOLD_SQL = f"CAST(floor({sql_unit_hash('vec_id')} * 3) AS INTEGER)"


@query(
    f"""WITH {VECTORS_SQL}, folds AS (SELECT {FOLD_SQL} AS fold, count(*) FILTER (WHERE tag = 'dry') AS positives,
  count(*) FILTER (WHERE tag <> 'dry') AS negatives FROM vectors GROUP BY fold)
SELECT reg_param, fold, positives, negatives, true AS valid FROM folds, (VALUES (0.0::DOUBLE), (0.1), (1.0)) AS t(reg_param)"""
)
def grid_search_auc(spark, folder):
    """A cross-validated search over the whole table. Areas depend on training, their range and the folds do not."""
    found = grid_search(_dry(spark, folder), "vec_id", "label", {"reg_param": [0.0, 0.1, 1.0]}, parallelism=3, method="md5")
    return found.select("reg_param", "fold", "positives", "negatives", F.col("roc_auc").between(0.0, 1.0).alias("valid"))


def fixed_weights(number: int, size: int) -> Weights:
    """A model by rule, so that its scores can be stated."""
    return Weights(tuple(((k * 7 + number * 5) % 13 - 6) / 10 for k in range(size)), number / 20)


def sql_fixed_score(number: str) -> str:
    """1 / (1 + exp(-(w . x + b))) of the model by rule; x is the vector."""
    weight = f"((k * 7 + {number} * 5) % 13 - 6) / 10.0::DOUBLE"
    product = f"list_sum(list_transform(range(len(x)), lambda k: x[k + 1] * ({weight})))"
    return f"1 / (1 + exp(-({product} + {number} / 20.0::DOUBLE)))"


@query(
    f"""WITH {VECTORS_SQL}, rows AS (SELECT {FOLD_SQL} AS fold, CAST(tag = 'dry' AS INTEGER) AS y, x FROM vectors),
scored AS (SELECT fold, cell, y, {sql_fixed_score('(cell * 3 + fold)')} AS s FROM rows, (SELECT unnest(range(2)) AS cell)),
ranked AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY fold, cell, s) - 1) / 2.0 AS place FROM scored WINDOW w AS (PARTITION BY fold, cell ORDER BY s)),
areas AS (SELECT cell, fold, sum(y) AS p, count(*) - sum(y) AS n, sum(y * place) AS places FROM ranked GROUP BY cell, fold)
SELECT CASE cell WHEN 0 THEN 0.5::DOUBLE ELSE 2 END AS reg_param, round(avg((places - p * (p + 1) / 2) / (p * n)), 9) AS mean_auc FROM areas GROUP BY cell"""
)
def grid_search_fixed_models(spark, folder):
    """The search's areas with models by rule in place of fits: every value and fold from one pass."""
    rows = _dry(spark, folder)
    size = len(rows.select("features").first()[0])
    models = {(c, f): fixed_weights(c * 3 + f, size) for c in range(2) for f in range(3)}
    found = grid_search(rows, "vec_id", "label", {"reg_param": [0.5, 2.0]}, fitted=models, method="md5")
    return mean_areas(found).select("reg_param", F.round("mean_auc", 9).alias("mean_auc"))


CLASS_ROWS = ", ".join(f"('{tag}', {k})" for k, tag in enumerate(CLASS_TAGS))


@query(
    f"""WITH {VECTORS_SQL}, tags(tag, k) AS (VALUES {CLASS_ROWS}),
scored AS (SELECT t.tag, split, CAST(v.tag = t.tag AS INTEGER) AS y, {sql_fixed_score('t.k')} AS score FROM vectors v, tags t),
steps(threshold) AS (VALUES {STEPS_SQL}),
tried AS (SELECT tag, threshold, {CELLS} FROM (SELECT tag, threshold, y, score >= threshold AS hit FROM scored, steps WHERE split = 'val') GROUP BY tag, threshold),
tuned AS (SELECT tag, threshold FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY CASE WHEN tp > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END DESC, threshold) AS place FROM tried) WHERE place = 1),
tested AS (SELECT tag, threshold, {CELLS} FROM (SELECT tag, threshold, y, score >= threshold AS hit FROM scored JOIN tuned USING (tag) WHERE split = 'test') GROUP BY tag, threshold)
{sql_metrics('tested')}"""
)
def fixed_models_evaluation(spark, folder):
    """Models by rule tuned on val and reported on test, all tags in one pass each."""
    rows = labelled_vectors(spark, folder)
    rows = materialise(multi_hot(rows, CLASS_TAGS, "tags").select("split", "features", *[f"y_{t}" for t in CLASS_TAGS]), "dataset")
    size = len(rows.select("features").first()[0])
    models = {tag: fixed_weights(k, size) for k, tag in enumerate(CLASS_TAGS)}
    part = {s: rows.filter(F.col("split") == s) for s in ("val", "test")}
    report = evaluate_per_tag(part["val"], part["test"], models)
    return report.withColumns({c: F.round(c, 9) for c in METRICS})


def run_on_documents(spark, folder, tfidf=False, train_only=False, method="xxhash64", vectors=VECTORS, text=None):
    """A whole run on documents: weak labels, features, centroids."""
    base = scratch_path(spark, "run")
    docs = table(spark, folder, "documents").select(
        "doc_id", F.col("doc_id").alias("user_id"), F.col("source").alias("recipe_id"),
        F.lit(None).cast("date").alias("date"), F.col("text"),
    )
    reviews = with_review_key(clean_documents(spark, folder).select(
        "doc_id", F.col("doc_id").alias("user_id"), F.col("source").alias("recipe_id"),
        F.lit("2020-01-01").alias("date"), "review_clean",
    ))
    write_table(reviews, f"{base}/reviews")
    stored = spark.read.parquet(f"{base}/reviews")
    weak = label(docs, WEAK_CONFIG).select("doc_id", "zs_labels")
    write_table(attach_by_key(stored, weak, "doc_id"), f"{base}/labelled")
    settings = {"labels": CORPUS_TAXONOMY.ids, "vectors": vectors, "tfidf": tfidf, "split_hash": method}
    settings |= {"text": text} if text else {}
    plan = feature_plan.FeaturePlan(**settings) if train_only else feature_plan.FeaturePlan.on_corpus(f"{base}/reviews", **settings)
    return base, feature_plan.build(spark, f"{base}/labelled", base, plan)


@query(
    "SELECT 'split_count' AS name, count(*)::DOUBLE AS total, true AS shares FROM documents "
    f"UNION ALL SELECT 'label_prevalence', NULL, true UNION ALL SELECT 'tag_threshold', NULL, true"
)
def feature_run(spark, folder):
    """Metrics of one run: split sizes sum to the rows; prevalences and thresholds are shares."""
    base, run_id = run_on_documents(spark, folder, tfidf=True)
    value, name = F.col("value"), F.col("name")
    return spark.read.parquet(f"{base}/metrics").groupBy("name").agg(
        F.sum(F.when(name == "split_count", value)).alias("total"),
        F.bool_and((name == "split_count") | value.between(-1.0, 1.0)).alias("shares"),
    )


def _tagged_facts(gold):
    """Per document what holds whatever was learned: lists agree with totals, no pair contradicts."""
    clash = [(F.col(f"pred_{a}") == 1) & (F.col(f"pred_{b}") == 1) for a, b in NEGATION_PAIRS if f"pred_{a}" in gold.columns and f"pred_{b}" in gold.columns]
    listed = (F.size("tag_list") == F.col("total_tags")) & (F.col("total_tags") == sum((F.col(f"pred_{t}") for t in CORPUS_TAXONOMY.ids), F.lit(0)))
    return gold.select("doc_id", listed.alias("listed"), reduce(or_, clash, F.lit(False)).alias("clash"))


@query("SELECT doc_id, true AS listed, false AS clash FROM documents")
def corpus_tagging(spark, folder):
    """Every document tagged with the models of a run, calibrated anew on its labelled rows."""
    base, run_id = run_on_documents(spark, folder)
    labelled = spark.read.parquet(f"{base}/labelled")
    out = tag_corpus(
        spark, base, run_id, f"{base}/reviews", f"{base}/gold", labelled=labelled, tags=CORPUS_TAXONOMY.ids
    )
    return _tagged_facts(spark.read.parquet(out))


@query("SELECT doc_id, true AS listed, false AS clash FROM documents")
def stored_model_tagging(spark, folder):
    """The same from the run's stored centroids and thresholds, of a run trained on its train split alone."""
    base, run_id = run_on_documents(spark, folder, train_only=True)
    out = tag_corpus(spark, base, run_id, f"{base}/reviews", f"{base}/gold", tags=CORPUS_TAXONOMY.ids)
    return _tagged_facts(spark.read.parquet(out))


@query("SELECT true AS run, true AS calibrations, true AS same_tags")
def recalibrated_thresholds(spark, folder):
    """Two calibrations of one run: each has one threshold per tag under its own id, the run keeps its own."""
    base, run_id = run_on_documents(spark, folder)
    labelled = spark.read.parquet(f"{base}/labelled")
    for _ in range(2):
        recalibrate(spark, base, run_id, labelled, tags=CORPUS_TAXONOMY.ids)
    found = spark.read.parquet(f"{base}/metrics").filter("name = 'tag_threshold'")
    each = found.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("tag").alias("tags"))
    own = F.col("run_id") == run_id
    return each.agg(
        F.bool_or(own).alias("run"), (F.count_if(~own) == 2).alias("calibrations"),
        (F.bool_and(F.col("n") == F.col("tags")) & (F.min("tags") == F.max("tags"))).alias("same_tags"),
    )


@query(
    f"""WITH {WEAK_LABELS_SQL}, tags AS (SELECT unnest({sql_strings(CORPUS_TAXONOMY.ids)}) AS tag), rows AS (
  SELECT labels, {sql_split('source')} AS split FROM documents JOIN weak USING (doc_id))
SELECT tag, count(*) FILTER (WHERE list_contains(labels, tag)) AS positives, count(*) AS n, true AS valid
FROM tags, rows WHERE split = 'test' GROUP BY tag"""
)
def run_evaluation(spark, folder):
    """Classifiers of every tag trained, tuned and tested on a run's dataset."""
    base, run_id = run_on_documents(spark, folder, method="md5")
    return _facts(train_and_evaluate(spark, base, run_id, tags=CORPUS_TAXONOMY.ids))


@query(f"WITH {CALIBRATION_SQL} SELECT tag, pos_count, round(threshold, 6) AS threshold, 4::BIGINT AS refused FROM thresholds")
def calibration_with_bad_vectors(spark, folder):
    """Null vectors, null elements and wrong lengths among the rows are left out and counted."""
    rows = labelled_vectors(spark, folder).select("tag", "split", "tags", F.col("features").cast("array<double>").alias("features"))
    one = rows.limit(1).select("tag", F.lit("train").alias("split"), "tags", "features")
    size = F.size("features")
    bad = [F.lit(None).cast("array<double>"), F.slice("features", 1, 3), F.array_repeat(F.lit(None).cast("double"), size), F.concat("features", F.array(F.lit(1.0)))]
    mixed = reduce(lambda a, b: a.unionByName(b), [one.withColumn("features", x) for x in bad], rows)
    refused = usable_vectors(mixed, refused=True).agg(F.count(F.lit(1))).first()[0]
    fitted = calibrate(mixed).select("tag", "pos_count", F.round("threshold", 6).alias("threshold"))
    return fitted.withColumn("refused", F.lit(refused).cast("bigint"))


@query(f"WITH {CALIBRATION_SQL} SELECT tag, pos_count, round(threshold, 6) AS threshold FROM thresholds")
def calibration_from_columns(spark, folder):
    """Centroids and thresholds from 0/1 columns, as a stored dataset has them."""
    rows = labelled_vectors(spark, folder).select("vec_id", "split", "tags", "features")
    stored = multi_hot(rows, CLASS_TAGS, "tags").drop("tags")
    return calibrate(stored.withColumn("tags", tags_set(CLASS_TAGS, "y_"))).select("tag", "pos_count", F.round("threshold", 6).alias("threshold"))
