from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tagloom.functions import text
from tagloom.operators import text_features
from tagloom.operators.text_features import TextSpec, Word2VecSpec
from tagloom.operators.weak_labels import WeakLabelConfig
from tagloom.plans import ingest, labelling
from tagloom.sources import csv_files, runs, storage

RECIPES = '''name,id,minutes,contributor_id,submitted,tags,nutrition,n_steps,steps,description,ingredients,n_ingredients
soup,1,10,7,2001-02-03,"['easy', 'main dish']","[1, 2, 3, 4, 5, 6, 7]",2,"['boil', ""don't burn""]","Good, ""hot""
soup",['salt'],1
'''


def reviews_csv(n=6):
    words = " ".join(["tasty"] * 20)
    lines = ["user_id,recipe_id,date,rating,review"]
    lines += [f'{i},1,2002-01-0{i + 1},{i},"{words}\nline {i}, ""quoted"""' for i in range(n)]
    return "\n".join([*lines, 'x,1,2002-01-01,5,"bad id"']) + "\n"


@pytest.fixture
def layers(spark, tmp_path):
    (tmp_path / "recipes.csv").write_text(RECIPES)
    (tmp_path / "reviews.csv").write_text(reviews_csv())
    layers = ingest.Layers(str(tmp_path / "tables"))
    counts = ingest.land_bronze(spark, str(tmp_path / "recipes.csv"), str(tmp_path / "reviews.csv"), layers)
    assert counts == (1, 7)
    return layers


def test_csv_to_gold(spark, layers):
    ingest.build_silver(spark, layers)
    ingest.build_gold(spark, layers)
    assert spark.read.parquet(layers.bronze_interactions_quarantine).count() == 1
    reviews = spark.read.parquet(layers.gold_reviews).collect()
    assert sorted(r["rating"] for r in reviews) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert all("line" in r["review_clean"] and "\n" not in r["review_clean"] for r in reviews)
    wide = spark.read.parquet(layers.gold_wide)
    assert wide.count() == 5 and wide.first()["steps_clean"] == "boil don t burn"
    assert wide.first()["description_clean"] == "good hot soup"
    assert "user_id" not in spark.read.parquet(layers.gold_vector_view).columns
    assert spark.read.parquet(layers.gold_ratings_view).columns == ["user_id", "recipe_id", "rating"]


def test_missing_inputs_are_all_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="a.csv.*b.csv"):
        storage.require_paths(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))


def test_untyped_scan(spark, tmp_path):
    (tmp_path / "r.csv").write_text(reviews_csv(1))
    rows = csv_files.scan_untyped(spark, str(tmp_path / "r.csv"))
    assert {t for _, t in rows.dtypes} == {"string"} and rows.count() == 2


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    storage.write_table(df, path, partition_by=["p"], files=2)
    assert storage.scan(spark, path, required=["id"], not_null=["id"]).count() == 10
    with pytest.raises(ValueError):
        storage.scan(spark, path, required=["gone"])
    storage.write_if_absent(df.limit(1), path)
    assert spark.read.parquet(path).count() == 10
    storage.write_if_absent(df.limit(1), path, force=True)
    assert spark.read.parquet(path).count() == 1


def test_runs(spark, tmp_path):
    base = str(tmp_path / "runs")
    assert runs.latest_runs(spark, base) == []
    for run_id in ("one", "two", "two", "three"):
        runs.register_run(spark, base, run_id)
    assert [r[0] for r in runs.latest_runs(spark, base)] == ["three", "two"]
    with pytest.raises(FileNotFoundError):
        runs.register_run(spark, base, "four", outputs=[f"{base}/nothing"])
    rows = spark.createDataFrame([("tag_threshold", "a", 0.5)], "name string, tag string, value double")
    for run_id in ("one", "two"):
        runs.append_metrics(rows, base, run_id)
    assert runs.read_metrics(spark, base, "two", "tag_threshold").count() == 1
    runs.write_manifest(spark, f"{base}/manifest", {"a": 1, "b": 1}, {"b": 2})
    assert runs.read_manifest(spark, f"{base}/manifest") == {"a": 1, "b": 2}


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = storage.shared_folder(spark)
    assert folder == named.rstrip("/") if named else folder
    assert storage.scratch_path(spark, "x").startswith(f"{folder}/x-")
    assert storage.materialise(spark.range(3)).count() == 3


def labelling_job(spark, tmp_path, chunks=4):
    reviews, todo, out = (str(tmp_path / n) for n in ("reviews", "todo", "out"))
    text = " ".join(["too", "salty"] * 10)
    rows = spark.range(1, 41).select(F.col("id").cast("string").alias("review_key"), F.lit(text).alias("review_clean"))
    rows.write.parquet(reviews)
    cfg = WeakLabelConfig(sample_n=40)
    labelling.prepare(spark, reviews, todo, cfg, chunk_rows=40 // chunks)
    assert spark.read.parquet(todo).count() == 40
    return reviews, todo, out, cfg


def test_labelling_resumes(spark, tmp_path):
    reviews, todo, out, cfg = labelling_job(spark, tmp_path)
    # What an attempt without a log entry has left is written anew, not added to.
    first = labelling.pending(spark, todo, out).filter("cast(review_key as int) <= 5")
    left = labelling.label(first, cfg).join(first.select("review_key", "chunk"), "review_key")
    storage.write_table(left, out, partition_by=["chunk"])
    assert labelling.labelled(spark, out).count() == 0
    some = labelling.label_pending(spark, todo, out, cfg, chunks=[0, 2])
    assert 0 < some < 40 and labelling.labelled(spark, out).count() == some
    assert labelling.pending(spark, todo, out).count() == 40 - some
    assert labelling.label_pending(spark, todo, out, cfg, parallelism=3) == 40 - some
    assert labelling.label_pending(spark, todo, out, cfg) == 0
    stored = labelling.labelled(spark, out)
    assert stored.count() == stored.select("review_key").distinct().count() == 40
    assert labelling.changed_chunks(spark, out, "review_key") == []
    labelling.attach(spark, reviews, out, str(tmp_path / "labelled"))
    labelled = spark.read.parquet(str(tmp_path / "labelled"))
    assert labelled.count() == 40 and labelled.first()["zs_labels"] == ["too_salty"]
    once = labelling.label_once(spark, todo, str(tmp_path / "once"), cfg)
    assert spark.read.parquet(once).count() == 40


def test_a_chunk_that_fails_leaves_nothing(spark, tmp_path):
    """A scorer that fails midway: other chunks are committed, the next call redoes the failed one alone."""
    _, todo, out, cfg = labelling_job(spark, tmp_path)
    bad = spark.read.parquet(todo).filter("review_key = '7'").first()["chunk"]
    victim = spark.read.parquet(todo).filter(F.col("chunk") == bad).withColumn(
        "review_clean", F.when(F.col("review_key") == "7", "poison " * 20).otherwise(F.col("review_clean")))
    storage.write_table(storage.materialise(victim.drop("chunk")), f"{todo}/chunk={bad}")

    def load(broken):
        def score(texts, prompts):
            if broken and any("poison" in t for t in texts):
                raise RuntimeError("scorer failed")
            return [[0.9] * len(prompts) for _ in texts]

        return lambda: score

    with pytest.raises(Exception, match="scorer failed"):
        labelling.label_pending(spark, todo, out, cfg, load(True), parallelism=2)
    done = labelling.committed(spark, out)
    assert bad not in done and len(done) == 3
    rows = labelling.labelled(spark, out).count()
    assert labelling.label_pending(spark, todo, out, cfg, load(False)) == 40 - rows
    stored = labelling.labelled(spark, out)
    assert stored.count() == stored.select("review_key").distinct().count() == 40
    storage.write_table(storage.materialise(stored.filter("review_key = '7'").drop("chunk")), f"{out}/chunk={bad}")
    assert labelling.changed_chunks(spark, out, "review_key") == [bad]


def test_positions_are_claimed_by_one_writer(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    base = str(tmp_path / "runs")
    names = [f"run-{k}" for k in range(12)]
    with ThreadPoolExecutor(4) as pool:
        positions = list(pool.map(lambda name: runs.register_run(spark, base, name), names))
    assert sorted(positions) == list(range(1, 13))
    found = runs.latest_runs(spark, base, 100)
    assert [r[0] for r in found] == [names[positions.index(p)] for p in range(12, 0, -1)]
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: storage.create_if_absent(spark, f"{base}/claims/one", f"{k}\n" * 1000), range(8)))
    assert sum(won) == 1
    assert (tmp_path / "runs/claims/one").read_text() == f"{won.index(True)}\n" * 1000
    assert storage.small_files(spark, f"{base}/nowhere") == {}


def tokens(spark, n=200):
    vocabulary = ["salt", "sugar", "soup", "bread", "crisp", "dry"]
    picks = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.get(
        F.array(*[F.lit(w) for w in vocabulary]), F.pmod(F.hash("id", i), F.lit(len(vocabulary)))))
    return spark.range(n).select(F.col("id").cast("string").alias("review_key"), picks.alias("tokens_all"))


def test_word2vec(spark):
    df = storage.materialise(tokens(spark).unionByName(spark.createDataFrame(
        [("empty", []), ("unknown", ["zzz"])], "review_key string, tokens_all array<string>")))
    spec = Word2VecSpec(size=5, min_count=2, iterations=1, partitions=1, out="v")
    model = text_features.fit_word2vec(df, spec)
    again = text_features.fit_word2vec(df, spec)
    rows = {r["review_key"]: r["v"].toArray() for r in text_features.embed(df, model, "v").collect()}
    assert all(len(v) == 5 for v in rows.values())
    assert not rows["empty"].any() and not rows["unknown"].any() and rows["0"].any()
    second = {r["review_key"]: r["v"].toArray() for r in text_features.embed(df, again, "v").collect()}
    assert all((rows[k] == second[k]).all() for k in rows)
    near = text_features.nearest_words(model.getVectors(), "salt", 3).collect()
    wanted = [(r["word"], r["similarity"]) for r in model.findSynonyms("salt", 3).collect()]
    assert [r["word"] for r in near] == [w for w, _ in wanted]
    assert all(abs(r["similarity"] - x) < 1e-6 for r, (_, x) in zip(near, wanted))
    assert text_features.nearest_words(model.getVectors(), "unheard", 3).count() == 0
    words = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    joined = text_features.embed_by_join(df, words, key="review_key", tokens="tokens_all", out="j", size=5)
    for r in joined.collect():
        assert max(abs(a - b) for a, b in zip(r["j"], rows[r["review_key"]])) < 1e-6
    with pytest.raises(ValueError, match="exceed"):
        text_features.fit_word2vec(df, Word2VecSpec(min_count=1, size=10**10))
    with pytest.raises(ValueError, match="writes"):
        text_features.embed(df, model, "other")


def test_words_and_both_vectors_must_fit_the_heap(spark):
    df = spark.range(1)
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    fitting = heap // (2 * 128 * 4 + text_features.WORD_BYTES)
    text_features._check_model(df, fitting, 128)
    with pytest.raises(ValueError, match="exceed"):  # one vector for each of them would fit
        text_features._check_model(df, fitting + 1, 128)


def test_token_stages_equal_columns(spark):
    df = spark.createDataFrame([("the soup was not too salty at all",), ("dry",), ("",)], "review_clean string")
    for n in (1, 2, 3):
        spec = TextSpec(ngram=n)
        staged = text_features.token_stages(spec).fit(df).transform(df)
        kept = text.without_words(text.word_tokens(F.col("review_clean")), spec.stopwords)
        native = staged.withColumn("k", kept)
        terms = F.concat(F.col("k"), text.ngrams(F.col("k"), n)) if n > 1 else F.col("k")
        assert native.filter(terms != F.col("tokens_all")).count() == 0
        assert text_features.drop_token_columns(staged, spec).columns == ["review_clean"]


def test_tfidf(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a"]), (3, [])], "id int, t array<string>")
    found = {(r["id"], r["term"]): r["tfidf"] for r in text_features.tfidf_terms(df, "id", "t").collect()}
    assert found[1, "b"] == 0.0 and abs(found[1, "a"] - 2 * 0.28768207245178085) < 1e-12
    spec = TextSpec(terms="t", hash_buckets=16)
    assert text_features.tfidf_stages(spec).fit(df).transform(df).count() == 3
    capped = {(r["id"], r["term"]): r["tfidf"] for r in text_features.capped_tfidf_terms(df, "id", "t", share=0.5).collect()}
    assert capped == {k: v for k, v in found.items() if k[1] == "a"}
    ties = spark.createDataFrame([(k, [f"w{k:03}"]) for k in range(100)], "id int, t array<string>")
    counts = text_features.document_terms(ties, "id", "t")
    assert sorted(r["term"] for r in text_features.frequent_terms(counts, 0.3).collect()) == [f"w{k:03}" for k in range(30)]
