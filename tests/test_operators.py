from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.functions.vectors import cosine
from tagloom.operators import (
    balancing, centroids, cleaning, conflicts, contracts, evaluation, gold, joins, labels, reports,
    scoring, selection, splits, taxonomy, training, weak_labels,
)

RAW = "user_id string, recipe_id string, date string, rating string, review string"


def test_contracts(spark):
    df = spark.createDataFrame([(1, None)], "a int, y_b int")
    with pytest.raises(ValueError, match="missing required columns"):
        contracts.require_columns(df, ["a", "z"], "table")
    assert contracts.columns_with_prefix(df, "y_") == ["y_b"]
    assert contracts.in_order(df, ["y_b", "z", "a"]).columns == ["y_b", "a"]
    with pytest.raises(ValueError):
        contracts.in_order(df, ["z"], strict=True)
    assert contracts.not_null(df, ["a", "y_b"]).count() == 0
    assert contracts.without_columns(df, ["a", "z"]).columns == ["y_b"]
    assert contracts.keep_or_derive(df, "y_b", F.lit(7)).first()["y_b"] == 7
    assert contracts.keep_or_derive(df, "a", F.lit(7)).first()["a"] == 1


def test_ratings(spark):
    rows = [("u", "r", "2002-01-01", v, "x") for v in ("0", "3", "4", "5", None, "abc")]
    typed = cleaning.coerce_interactions(spark.createDataFrame(rows, RAW))
    liked = {r["rating"]: r["liked"] for r in gold.with_liked(typed).collect()}
    assert liked == {3.0: 0, 4.0: 1, 5.0: 1}


def test_interactions_without_key_go(spark):
    rows = [(None, "r", "2002-01-01", "5", "x"), ("u", None, "2002-01-01", "5", "x"), ("u", "r", "bad", "5", "x")]
    kept = cleaning.coerce_interactions(spark.createDataFrame(rows, RAW)).collect()
    assert len(kept) == 1 and kept[0]["date"] is None


def test_token_band(spark):
    texts = [" ".join(["w"] * n) for n in (14, 15, 120, 121)] + ["w  " + " ".join(["w"] * 13)]
    df = spark.createDataFrame([(t,) for t in texts], "review string")
    assert sorted(r["token_count"] for r in cleaning.within_token_band(df).collect()) == [15, 15, 120]


def test_clean_review_without_text_column(spark):
    assert cleaning.with_clean_review(spark.range(1)).first()["review_clean"] == ""


def test_clean_recipes_keeps_given_columns(spark):
    df = spark.createDataFrame(
        [("1", "n", "x", "c", "s", "['T']", "[1,2,3,4,5,6,7]", "1", "['A']", "D!", "['B c']", "2", None),
         ("2", "n", "5", "c", "2001-02-03", "['T']", "[1]", "1", "['A']", None, "broken [", "2", "given")],
        "id string, name string, minutes string, contributor_id string, submitted string, tags string, "
        "nutrition string, n_steps string, steps string, description string, ingredients string, "
        "n_ingredients string, tags_clean string",
    )
    first, second = cleaning.clean_recipes(df).orderBy("id").collect()
    assert first["tags_clean"] == "t" and second["tags_clean"] == "given"
    assert first["ingredients_clean"] == "b_c" and second["ingredients_clean"] is None
    assert first["minutes"] is None and first["submitted"] is None and second["minutes"] == 5.0
    assert second["carbs"] is None and second["description_clean"] == ""
    assert gold.gold_recipes(cleaning.clean_recipes(df)).count() == 0


def test_gold_reviews_collapse_copies(spark):
    rows = [("u", "r", "2002-01-01", "5", "Nice!")] * 500 + [("u", "r", "2002-01-01", "4", "nice")]
    silver = cleaning.with_clean_review(cleaning.coerce_interactions(spark.createDataFrame(rows, RAW)))
    found = gold.gold_reviews(silver).collect()
    assert sorted(r["rating"] for r in found) == [4.0, 5.0] and found[0]["review_key"] == found[1]["review_key"]


def test_hot_keys_are_split_without_changing_the_join(spark):
    many = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    one = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        split = joins.join_split(many, one, "k", how)
        plain = many.join(one, "k", how)
        assert split.columns == plain.columns and split.exceptAll(plain).count() == plain.exceptAll(split).count() == 0
    assert [r["k"] for r in many.filter(joins.frequent_key(many, "k")).select("k").distinct().collect()] == [7]
    with pytest.raises(ValueError):
        joins.join_to_one(many, one, "k", "full")


@pytest.fixture
def fixed_plans(spark):
    """Eight partitions as they fall: no adaptive changes, no broadcasts."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def partition_sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_equal_rows_and_null_keys_are_dealt_out(spark, fixed_plans):
    one = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    equal = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 400).alias("k"))
    sizes = partition_sizes(joins.join_to_one(equal, one, "k"))
    assert sum(sizes) == 10_000 and sizes[-1] < 3 * 10_000 / 8
    nulls = spark.range(1000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 400).alias("k"), "id").repartition(8)
    joined = joins.join_to_one(nulls, one, "k", "left")
    assert joined.count() == 1000 and joined.filter("k is null and v is null").count() == 900
    assert partition_sizes(joined)[-1] < 200


def test_join_evaluates_its_rows_once(spark, fixed_plans, tmp_path):
    spark.range(1000).select((F.col("id") % 7).alias("k")).write.parquet(str(tmp_path / "many"))
    one = spark.range(7).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    many = spark.read.parquet(str(tmp_path / "many")).mapInPandas(seen, "k bigint")
    assert joins.join_to_one(many, one, "k").count() == 1000
    assert calls.value == 1000


def test_scans_are_not_written_for_a_join(spark, fixed_plans, tmp_path, monkeypatch):
    spark.range(5000).select((F.col("id") % 900).alias("k"), F.lit("text").alias("_row"), F.lit(1).alias("_part")).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many")).filter("k >= 0").withColumn("w", F.upper("_row"))
    one = spark.range(900).select(F.col("id").alias("k"), F.lit(1).alias("_parts"))
    written = []
    monkeypatch.setattr(joins, "materialise", lambda df, name="stage": written.append((name, df.count())) or df)
    joined = joins.join_to_one(many, one, "k")
    assert joined.count() == 5000 and joined.columns == ["k", "_row", "_part", "w", "_parts"]
    assert written == [("frequent", 0)]
    assert joins.repeatable(many) and not joins.repeatable(many.groupBy("k").count())
    assert not joins.repeatable(many.withColumn("r", F.rand(1)))


def test_frequent_rows_too_large_to_broadcast(spark, fixed_plans, monkeypatch):
    monkeypatch.setattr(joins, "HOT_BYTES", 1)
    many = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    one = spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        split, plain = joins.join_split(many, one, "k", how), many.join(one, "k", how)
        assert split.exceptAll(plain).count() == plain.exceptAll(split).count() == 0
    empty = many.limit(0)
    assert joins.join_split(empty, one, "k", "left").collect() == []


def test_session_threshold_decides_on_broadcasts(spark, fixed_plans):
    assert joins.broadcast_limit(spark.range(1)) == -1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    assert joins.broadcast_limit(spark.range(1)) == 1 << 20


def test_tag_descriptions(spark):
    tags = taxonomy.Taxonomy((taxonomy.Tag("too_salty", "taste", "negative", ("too salty",), description="Too much salt.", examples=("way too salty",)),))
    row = tags.described(spark).first()
    assert (row["label"], row["description"], row["examples"]) == ("Too salty", "Too much salt.", ["way too salty"])


def test_views(spark):
    df = spark.createDataFrame([("u", "r", 5.0, "x")], "user_id string, recipe_id string, rating double, review string")
    assert gold.vector_view(df).columns == ["recipe_id", "rating"]
    assert gold.ratings_view(df).columns == ["user_id", "recipe_id", "rating"]
    with pytest.raises(ValueError):
        gold.ratings_view(df.drop("user_id"))


def test_entity_never_straddles_splits(spark):
    df = spark.range(3000).select((F.col("id") % 100).cast("string").alias("recipe_id"), "id")
    out = splits.assign_splits(df)
    assert out.groupBy("recipe_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    table = splits.split_table(out.withColumn("review_key", F.col("id") % 7))
    assert table.count() == 7 and table.columns == ["review_key", "recipe_id", "split"]


def test_multi_hot(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "zs_labels array<string>")
    out = labels.multi_hot(df, ["a", "b"])
    assert [tuple(r)[1:] for r in out.collect()] == [(1, 1), (0, 0), (0, 0)]
    assert dict(out.dtypes)["y_a"] == "int"
    with pytest.raises(ValueError):
        labels.multi_hot(df, ["a"], "other")


def test_tag_list(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (None, 1)], "pred_a int, pred_b int")
    out = [(r["tag_list"], r["total_tags"]) for r in labels.with_tag_list(df, ["a", "b"]).collect()]
    assert out == [([], 0), (["a", "b"], 2), (["b"], 1)]


@pytest.mark.parametrize(
    ("preds", "sims", "expected"),
    [
        ((1, 1), (0.9, 0.5), (1, 0)),
        ((1, 1), (0.5, 0.5), (0, 1)),
        ((1, 1), (0.4, 0.5), (0, 1)),
        ((1, 0), (0.4, 0.5), (1, 0)),
        ((0, 0), (0.4, 0.5), (0, 0)),
    ],
)
def test_conflicts(spark, preds, sims, expected):
    df = spark.createDataFrame(
        [(*preds, *sims)], "pred_moist_tender int, pred_dry int, sim_moist_tender double, sim_dry double"
    )
    out = conflicts.resolve_conflicts(df)
    row = out.first()
    assert (row["pred_moist_tender"], row["pred_dry"]) == expected and row["total_tags"] == sum(expected)
    assert conflicts.conflict_counts(out).first()["conflicts"] == 0
    assert conflicts.conflict_counts(df).first()["conflicts"] == int(preds == (1, 1))


def vectors(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        tags = [t for t, p in (("a", 0.5), ("b", 0.2), ("a", 0.1)) if rng.random() < p]
        v = [float(x) for x in rng.normal(size=4) + (2 if "a" in tags else 0)]
        rows.append((i, "train" if i % 5 else "val", tags if i % 11 else None, [0.0] * 4 if i % 17 == 0 else v))
    rows.append((n, "train", ["a"], None))
    return spark.createDataFrame(rows, "id int, split string, tags array<string>, features array<double>")


def test_calibration_equals_two_pass_form(spark):
    df = vectors(spark)
    rows = [r for r in df.collect() if r["split"] == "train" and r["features"] is not None]
    found = {r["tag"]: r for r in centroids.calibrate(df).collect()}
    assert set(found) == {"a", "b"}
    for tag in found:
        own = np.array([r["features"] for r in rows if tag in (r["tags"] or [])])
        mean = own.mean(axis=0)
        norms = np.linalg.norm(own, axis=1) * np.linalg.norm(mean)
        sims = np.divide(own @ mean, norms, out=np.zeros(len(own)), where=norms > 0)
        assert found[tag]["pos_count"] == len(own)
        assert np.allclose(found[tag]["centroid"], mean)
        assert math.isclose(found[tag]["threshold"], sims.mean(), abs_tol=1e-12)
    assert {r["tag"] for r in centroids.calibrate(df, only=["b", "c"]).collect()} == {"b"}


def test_own_similarity_averages_to_the_threshold(spark):
    df = vectors(spark).filter("split = 'train'")
    fitted = centroids.calibrate(df)
    long = df.filter("features is not null").select("features", F.explode(F.array_distinct("tags")).alias("tag"))
    own = centroids.own_centroid_similarity(long, fitted).groupBy("tag").agg(F.avg("sim").alias("m"))
    for r in own.join(fitted, "tag").collect():
        assert math.isclose(r["m"], r["threshold"], abs_tol=1e-12)


def test_scoring_engines_agree(spark):
    df = vectors(spark)
    model = scoring.TagModel.load(centroids.calibrate(df))
    arrow = {r["id"]: r for r in scoring.score_wide(df, model).collect()}
    native = {r["id"]: r for r in scoring.score_wide(df, model, engine="native").collect()}
    long = {(r["id"], r["tag"]): r["sim"] for r in scoring.score_long(df, model, keep=["id"]).collect()}
    for i in arrow:
        for t in model.tags:
            a, b = arrow[i][f"sim_{t}"], native[i][f"sim_{t}"]
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, abs_tol=1e-9))
            assert a is None or long[i, t] == a
    with pytest.raises(ValueError):
        scoring.similarities(F.col("features"), model, "other")


def test_pivot_equals_wide(spark):
    df = vectors(spark).filter("features is not null")
    model = scoring.TagModel.load(centroids.calibrate(df))
    wide = scoring.score_wide(df, model).select("id", "sim_a", "sim_b")
    back = scoring.pivot_wide(scoring.score_long(df, model, keep=["id"]), ["b", "a"], keys=["id"])
    assert wide.exceptAll(back).count() == 0 and back.count() == wide.count()


def test_absent_centroid_predicts_zero(spark):
    df = vectors(spark)
    model = scoring.TagModel.load(centroids.calibrate(df))
    out = scoring.apply_thresholds(scoring.score_wide(df, model), model.thresholds, tags=["a", "zzz"])
    assert out.agg(F.max("pred_zzz")).first()[0] == 0
    assert conflicts.resolve_conflicts(out, [("a", "gone")]).count() == out.count()


def test_models_of_any_number_of_tags(spark, monkeypatch):
    rows = spark.createDataFrame([(f"t{k:02}", [1.0, float(k)]) for k in range(20)], "tag string, centroid array<double>")
    model = scoring.TagModel.load(rows)
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, features array<double>")
    whole = df.select(scoring.similarities(F.col("features"), model).alias("s")).collect()
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 48)
    blocks = df.select(scoring.similarities(F.col("features"), model).alias("s")).collect()
    assert blocks[0]["s"] == pytest.approx(whole[0]["s"]) and len(blocks[0]["s"]) == 20 and blocks[1]["s"] is None
    with pytest.raises(ValueError, match="No centroids"):
        scoring.TagModel.load(rows.limit(0))


def test_drift(spark):
    one = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0])], "tag string, centroid array<double>")
    two = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, -1.0])], "tag string, centroid array<double>")
    first, second = centroids.centroid_drift(one, two).collect()
    assert (first["tag"], first["identical"], second["identical"]) == ("b", False, True)
    assert centroids.vectors_differ(one, two, "b") and not centroids.vectors_differ(one, two, "a")
    with pytest.raises(ValueError):
        centroids.vectors_differ(one, two, "z")


def test_taxonomy(spark):
    v1 = taxonomy.taxonomy()
    assert len(v1.ids) == 17 and len(set(v1.hypotheses)) == 34 and len(v1.groups) == 5
    assert v1.polarity["substitution_modification"] == "neutral"
    assert {t for p in taxonomy.NEGATION_PAIRS for t in p} <= set(v1.ids)
    assert v1.frame(spark).count() == 34
    with pytest.raises(ValueError):
        taxonomy.taxonomy("v2")
    with pytest.raises(ValueError, match="without a hypothesis"):
        taxonomy.Taxonomy((taxonomy.Tag("x", "g", "neutral", ()),))


SMALL = taxonomy.Taxonomy(
    (
        taxonomy.Tag("good", "g", "positive", ("good",)),
        taxonomy.Tag("bad", "g", "negative", ("bad",)),
        taxonomy.Tag("worse", "g", "negative", ("worse",)),
        taxonomy.Tag("mixed", "g", "neutral", ("mixed",)),
    )
)


@pytest.mark.parametrize(
    ("scores", "gate", "expected", "fallback"),
    [
        ({"good": 0.86}, 0.55, ["good"], False),
        ({"good": 0.84}, 0.55, [], False),
        ({"bad": 0.40}, 0.55, ["bad"], False),
        ({"mixed": 0.55}, 0.55, ["mixed"], False),
        ({"mixed": 0.50, "bad": 0.1}, 0.35, ["mixed"], True),
        ({"mixed": 0.30, "good": 0.8}, 0.35, [], False),
        ({"worse": 0.36, "bad": 0.36}, 0.35, ["bad"], True),
        ({}, 0.35, [], False),
    ],
)
def test_assign(spark, scores, gate, expected, fallback):
    df = spark.createDataFrame([("k", scores)], "review_key string, tag_scores map<string,double>")
    cfg = weak_labels.WeakLabelConfig(taxonomy=SMALL, fallback_gate=gate)
    row = weak_labels.assign(df, cfg).first()
    assert row["zs_labels"] == expected and row["zs_used_fallback"] is fallback
    assert row["zs_num_labels"] == len(expected)
    assert row["zs_fallback_choice"] == (expected[0] if fallback else None)
    assert row["zs_max_score"] == max(scores.values(), default=0.0)
    assert row["zs_fallback_candidate_max"] == max((v for t, v in scores.items() if t != "good"), default=0.0)


def test_fallback_settings(spark):
    df = spark.createDataFrame([("k", {"good": 0.5, "bad": 0.3})], "review_key string, tag_scores map<string,double>")
    allow = weak_labels.WeakLabelConfig(taxonomy=SMALL, fallback_gate=0.2, fallback_allow_positive=True, fallback_top_k=2)
    assert weak_labels.assign(df, allow).first()["zs_labels"] == ["good", "bad"]
    off = weak_labels.WeakLabelConfig(taxonomy=SMALL, fallback_gate=0.2, fallback_top_k=0)
    assert weak_labels.assign(df, off).first()["zs_labels"] == []


def test_lexicon_on_the_default_taxonomy(spark):
    df = spark.createDataFrame(
        [("1", "Way TOO salty, too much salt!"), ("2", "won't make again"), ("3", ""), ("4", None)],
        "review_key string, review_clean string",
    )
    found = {r["review_key"]: r["zs_labels"] for r in weak_labels.label(df).collect()}
    assert "too_salty" in found["1"] and "would_not_make_again" in found["2"] and found["3"] == found["4"] == []


def test_model_scorer_sees_prompts_and_long_rows_agree(spark):
    df = spark.createDataFrame([("1", "bad"), ("2", None)], "review_key string, review_clean string")

    def load():
        def score(texts, prompts):
            assert prompts[0] == "This review says the recipe was good."
            return [[1.0 if t and t in p else 0.0 for p in prompts] for t in texts]

        return score

    cfg = weak_labels.WeakLabelConfig(taxonomy=SMALL)
    found = {r["review_key"]: r["zs_labels"] for r in weak_labels.label(df, cfg, load).collect()}
    assert found == {"1": ["bad"], "2": []}
    long = spark.createDataFrame(
        [("1", "bad", 0.2), ("1", "bad", 0.7), ("1", "unknown", 0.9), ("1", "good", -1.0)],
        "review_key string, hypothesis string, score double",
    )
    assert dict(r[1:] for r in weak_labels.roll_up(long, SMALL).collect()) == {"bad": 0.7, "good": 0.0}


def test_sample_exactly(spark):
    df = spark.range(5000).select("id")
    picked = {r["id"] for r in selection.sample_exactly(df, 100, "id").collect()}
    again = {r["id"] for r in selection.sample_exactly(df.repartition(13), 100, "id").collect()}
    assert len(picked) == 100 and picked == again
    assert {r["id"] for r in selection.sample_exactly(df, 100, "id", seed=7).collect()} != picked
    assert selection.sample_exactly(df, 9000, "id").count() == 5000
    order = F.md5(F.concat_ws("::", F.lit("42"), F.col("id").cast("string")))
    assert {r["id"] for r in df.orderBy(order).limit(100).collect()} == picked


def test_large_samples_never_meet_in_one_task(spark):
    df = spark.range(0, 2_500_000, 1, 8)
    sample = selection.sample_exactly(df, 1_200_000, "id")
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("TakeOrdered", "GlobalLimit", "SinglePartition", "Exchange"))
    assert sample.count() == 1_200_000


def test_selection(spark):
    base = spark.createDataFrame([("1", "old"), ("2", "old"), ("2", "older")], "review_key string, v string")
    late = spark.createDataFrame([("2", "new"), ("3", "new")], "review_key string, v string")
    merged = {r["review_key"]: r["v"] for r in selection.one_per_key([base, late], prefer=["v"]).collect()}
    assert merged == {"1": "old", "2": "new", "3": "new"}
    assert [r["review_key"] for r in selection.without_keys(base, late).collect()] == ["1"]
    risky = spark.createDataFrame([(5.0, "too salty"), (3.0, "salty"), (5.0, "salted")], "rating double, review_clean string")
    assert selection.conflict_candidates(risky).count() == 1


def test_class_weights(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0), (0, 0)], "y_a int, y_b int")
    found = {r["label"]: r for r in evaluation.class_weights(df, ["a", "b"]).collect()}
    assert found["a"]["w_pos"] == 2.0 and math.isclose(found["a"]["w_neg"], 2 / 3)
    assert found["b"]["w_pos"] == found["b"]["w_neg"] == 1.0
    out = evaluation.with_class_weights(df, ["a", "b"])
    assert [r["w_a"] for r in out.collect()][0] == 2.0 and out.agg(F.max("w_b")).first()[0] == 1.0


def test_sweep_matches_one_threshold_at_a_time(spark):
    rng = np.random.default_rng(5)
    rows = [("t", int(y), float(s)) for y, s in zip(rng.integers(0, 2, 400), rng.random(400).round(2))]
    df = spark.createDataFrame(rows, "tag string, y int, score double")
    swept = {r["threshold"]: r for r in evaluation.sweep(df).collect()}
    assert len(swept) == 20
    for threshold in evaluation.SWEEP[::4]:
        alone = evaluation.confusion_at(df, "y", "score", threshold).first()
        assert all(math.isclose(alone[c], swept[threshold][c]) for c in ("tp", "fp", "tn", "fn", "f1", "youden_j"))


def test_best_threshold_ties_take_the_lowest(spark):
    df = spark.createDataFrame([("t", 1, 0.5), ("t", 0, 0.02), ("none", 0, 0.9), ("none", 0, 0.001)],
                               "tag string, y int, score double")
    best = {r["tag"]: r for r in evaluation.best_threshold(evaluation.sweep(df)).collect()}
    assert best["t"]["threshold"] == 0.06 and best["t"]["f1"] == 1.0
    assert best["none"]["threshold"] == 0.01 and best["none"]["f1"] == 0.0


def test_reports_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "y_a int, pred_a int, split string")
    assert reports.label_prevalence(empty, ["a"]).first()["prevalence"] == 0.0
    assert tuple(reports.tag_totals(empty, ["a"]).first()) == ("a", 0, 0.0)


def test_co_occurrence_is_symmetric(spark):
    df = spark.createDataFrame([(["a", "b"],)] * 3 + [(["b"],), ([],)], "tag_list array<string>")
    found = {(r["tag_a"], r["tag_b"]): r["n"] for r in reports.co_occurrence(df).collect()}
    assert found == {("a", "a"): 3, ("a", "b"): 3, ("b", "a"): 3, ("b", "b"): 4}


@pytest.mark.parametrize("method", ["xxhash64", "md5"])
def test_resampling(spark, method):
    df = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("c"))
    kwargs = {"method": method}
    for balanced, size in ((balancing.undersample(df, "c", "id", **kwargs), 400), (balancing.oversample(df, "c", "id", **kwargs), 3600)):
        assert dict(balanced.groupBy("c").count().collect()) == {"rare": size, "common": size}
    sized = balancing.resample(df, "c", {"rare": 1037, "common": 1}, "id", **kwargs)
    assert dict(sized.groupBy("c").count().collect()) == {"rare": 1037, "common": 1}
    times = {r["count"] for r in sized.filter("c = 'rare'").groupBy("id").count().collect()}
    assert times == {2, 3}
    other = balancing.resample(df.repartition(7), "c", {"rare": 1037, "common": 1}, "id", **kwargs)
    assert other.exceptAll(sized).count() == 0
    mixed = df.withColumn("c", F.when(F.col("id") % 7 != 0, F.col("c")))
    kept = dict(balancing.resample(mixed, "c", {"rare": 0}, "id", **kwargs).groupBy("c").count().collect())
    assert kept == {None: 572, "common": mixed.filter("c = 'common'").count()}
    assert balancing.undersample(mixed, "c", "id").filter("c is null").count() == 572
    assert balancing.oversample(mixed, "c", "id").filter("c is null").count() == 572
    assert balancing.resample(df, "c", {}, "id").count() == 4000
    assert balancing.undersample(df.limit(0), "c", "id").count() == 0


def test_helper_columns_do_not_clash(spark):
    """Tables with columns named like the operators' own keep them."""
    names = ["size", "times", "last", "copy", "range", "sims", "place", "frame", "hits", "raw", "_row", "_part", "c"]
    df = spark.range(40).select("id", F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("k"), *[F.lit(n).alias(n) for n in names])
    out = balancing.undersample(df, "k", "id")
    assert out.columns == df.columns and out.count() == 20 and out.filter("copy = 'copy' AND size = 'size' AND c = 'c'").count() == 20
    texts = weak_labels.with_lexicon_scores(df.withColumn("review_clean", F.lit("too salty")))
    assert texts.columns == [*df.columns, "review_clean", "hypothesis_scores"] and texts.first()["hits"] == "hits"
    one = selection.one_per_key([df, df.withColumn("hits", F.lit("new"))], "id")
    assert one.columns == df.columns and one.filter("hits = 'new' AND frame = 'frame'").count() == 40
    model = scoring.TagModel.load(spark.createDataFrame([("t", [1.0, 0.0])], "tag string, centroid array<double>"))
    rows = df.withColumn("features", F.array(F.lit(1.0), F.lit(1.0)))
    assert scoring.score_wide(rows, model).columns == [*rows.columns, "sim_t"]
    assert scoring.score_long(rows, model, keep=["id", "sims", "place"]).columns == ["id", "sims", "place", "tag", "sim"]
    assert scoring.assigned_long(rows, model, keep=["id", "place"]).columns == ["id", "place", "tag", "sim"]
    scaled = balancing.fit_min_max(df.withColumn("v", F.col("id").cast("double")), ["v"]).transform(df.withColumn("v", F.col("id").cast("double")))
    assert scaled.first()["raw"] == "raw"


def test_usable_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [1.0]), (5, [0.0, 0.0]), (6, [])]
    df = spark.createDataFrame(rows, "id int, features array<double>")
    assert {r["id"] for r in centroids.usable_vectors(df).collect()} == {1, 5}
    assert {r["id"] for r in centroids.usable_vectors(df, refused=True).collect()} == {2, 3, 4, 6}
    assert {r["id"] for r in centroids.usable_vectors(df, size=1).collect()} == {4}


def test_stacked_probabilities_equal_each_model(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    df = vectors(spark).filter("features is not null")
    df = labels.multi_hot(df, ["a", "b"], "tags").withColumn("features", array_to_vector("features"))
    models = training.fit_per_tag(df, ["a", "b"], training.LogisticSpec(reg_param=0.1))
    stacked = training.probabilities(df, models).groupBy("tag").agg(F.sum("score").alias("s")).collect()
    for r in stacked:
        own = models[r["tag"]].transform(df).agg(F.sum(vector_to_array("probability")[1])).first()[0]
        assert math.isclose(r["s"], own, rel_tol=1e-9)


def slow_auc(pairs):
    wins = [(s > t) + (s == t) / 2 for y, s in pairs if y == 1 for z, t in pairs if z == 0]
    return sum(wins) / len(wins) if wins else None


def test_areas_of_all_groups(spark):
    rng = np.random.default_rng(8)
    rows = [("wide", int(y), float(s)) for y, s in zip(rng.integers(0, 2, 3000), rng.random(3000))]
    rows += [("ties", int(y), float(s) / 4) for y, s in zip(rng.integers(0, 2, 900), rng.integers(0, 4, 900))]
    rows += [("one", 1, 0.5), ("gone", 1, None), ("gone", None, 0.3), ("gone", 2, 0.3), (None, 1, 0.7), (None, 0, 0.7), (None, 0, 0.1)]
    df = spark.createDataFrame(rows, "tag string, y int, score double").repartition(7)
    found = {r["tag"]: r["roc_auc"] for r in evaluation.roc_auc(df).collect()}
    assert found.keys() == {"wide", "ties", "one", None} and found["one"] is None
    for tag in ("wide", "ties", None):
        assert math.isclose(found[tag], slow_auc([(y, s) for t, y, s in rows if t == tag]), rel_tol=1e-12)
    assert evaluation.roc_auc(df.limit(0)).collect() == []
    clash = df.withColumn("range", F.lit(1)).withColumnRenamed("tag", "place")
    assert {r["place"]: r["roc_auc"] for r in evaluation.roc_auc(clash, ["place"]).collect()} == found
    assert evaluation.classification_report(df.limit(0), "y", "score").first()["roc_auc"] is None


def test_grid_search_equals_single_fits(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(3)
    rows = [(k, int(y), [float(y) + rng.normal(), rng.normal()]) for k, y in enumerate(rng.integers(0, 2, 300))]
    df = spark.createDataFrame(rows, "k int, y int, v array<double>").withColumn("v", array_to_vector("v")).cache()
    found = training.grid_search(df, "k", "y", {"reg_param": [0.0, 0.5], "elastic_net": [0.0, 1.0]}, features="v", folds=3)
    found = {(r["reg_param"], r["elastic_net"], r["fold"]): r["roc_auc"] for r in found.collect()}
    assert len(found) == 12
    for (reg, net, fold), area in found.items():
        trainer = training.LogisticSpec(reg_param=reg, elastic_net=net).trainer("y", "v")
        inside = training.fold_of("k", 3)
        scored = trainer.fit(df.filter(inside != fold)).transform(df.filter(inside == fold))
        alone = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="probability", numBins=0).evaluate(scored)
        assert math.isclose(area, alone, abs_tol=1e-9)
    df.unpersist()


def test_fits_run_side_by_side(spark):
    """As many at a time as asked for, each in a pool of its own, with results in order."""
    import threading
    import time

    lock, now, most, pools = threading.Lock(), [0], [0], set()

    def task(k):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        found = spark.range(k + 1).count()
        time.sleep(0.2)
        with lock:
            now[0] -= 1
        return found

    tasks = [lambda k=k: task(k) for k in range(7)]
    assert training.side_by_side(spark.range(1), tasks, 3) == list(range(1, 8))
    assert most[0] == 3 and pools == {"fit-0", "fit-1", "fit-2"}
    most[0] = 0
    training.side_by_side(spark.range(1), tasks[:3], 1)
    assert most[0] == 1
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_kappa_of_perfect_and_opposite(spark):
    df = spark.createDataFrame([(1, 1, 3), (2, 2, 2), (3, 3, 1)], "a int, same int, flipped int")
    assert evaluation.quadratic_kappa(df, "a", "same").first()[0] == 1.0
    assert math.isclose(evaluation.quadratic_kappa(df, "a", "flipped").first()[0], -1.0)


def test_cosine_of_columns_is_symmetric(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, -1.0])], "a array<double>, b array<double>")
    x, y = df.select(cosine(F.col("a"), F.col("b")), cosine(F.col("b"), F.col("a"))).first()
    assert math.isclose(x, y)
