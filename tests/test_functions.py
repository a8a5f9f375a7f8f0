from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom.functions import keys, metrics, parsing, text, vectors


def one(spark, column, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(column).first()[0]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("Don't!  BAKE-it", "don t bake-it"),
        ("jalapeño", "jalape o"),
        (None, ""),
        ("   ", ""),
        ("\tA\n\nb ", "a b"),
        ("--x", "--x"),
    ],
)
def test_clean_text(spark, raw, expected):
    assert one(spark, text.clean_text(F.col("v")), raw) == expected


def test_clean_text_can_fold_accents(spark):
    assert one(spark, text.clean_text(F.col("v"), fold_accents=True), "Jalapeño crème") == "jalapeno creme"


def test_clean_text_equals_two_replacements(spark):
    rows = spark.createDataFrame(
        [("a  b",), (" a.b-c ",), ("é a",), ("x y",), ("1\x0b2",), ("",), ("- -",)], "v string"
    )
    lowered = F.lower("v")
    slow = F.trim(F.regexp_replace(F.regexp_replace(lowered, r"[^a-z0-9\s-]", " "), r"\s+", " "))
    assert rows.filter(text.clean_text(F.col("v")) != slow).count() == 0


@pytest.mark.parametrize("raw", ["a b", "a  b", " a", "a ", "", "a\tb\n c", "aé b"])
def test_token_counts_equal_split_sizes(spark, raw):
    assert one(spark, text.raw_token_count(F.col("v")), raw) == len(raw.split(" "))
    split = F.size(F.split(F.col("v"), r"\s+"))
    assert one(spark, text.clean_token_count(F.col("v")) == split, raw)


def test_token_counts_of_null(spark):
    assert one(spark, text.raw_token_count(F.col("v")), None) is None
    assert one(spark, text.clean_token_count(F.col("v")), None) == 1


@pytest.mark.parametrize(
    ("tokens", "n", "expected"),
    [
        (["a", "b", "c"], 2, ["a b", "b c"]),
        (["a", "b", "c"], 3, ["a b c"]),
        (["a"], 2, []),
        ([], 2, []),
        (None, 2, None),
    ],
)
def test_ngrams(spark, tokens, n, expected):
    assert one(spark, text.ngrams(F.col("v"), n), tokens, "v array<string>") == expected


def test_stopwords(spark):
    words = text.stopword_list(extra=("zest", "the"))
    assert {"the", "too", "don"} <= set(words) and words.count("the") == 1
    assert not {"no", "nor", "not"} & set(words)
    assert "not" in text.stopword_list(keep_negations=False)
    assert not {"too", "very", "don", "t"} & set(text.stopword_list(keep_intensifiers=True))
    kept = text.without_words(F.col("v"), words)
    assert one(spark, kept, ["The", "not", "salty", "salty"], "v array<string>") == ["not", "salty", "salty"]


def test_word_matches(spark):
    found = text.contains_any_word(F.col("v"), ["hot", "salt"])
    assert one(spark, found, "too hot today") and not one(spark, found, "hotter salted")
    assert [one(spark, text.looks_textual(F.col("v")), v) for v in ("123", "12 3", "abc")] == [False, True, True]


def test_words_are_literal(spark):
    df = spark.createDataFrame([("axb",), ("a.b",), (r"a\Eb",)], "v string")
    assert [r["v"] for r in df.filter(text.contains_any_word(F.col("v"), ["a.b"])).collect()] == ["a.b"]
    assert [r["v"] for r in df.filter(text.contains_any_word(F.col("v"), [r"a\Eb"])).collect()] == [r"a\Eb"]


@pytest.mark.parametrize(
    ("literal", "expected"),
    [
        ("['a b', 'c']", ["a b", "c"]),
        ("['salt', \"baker's yeast\"]", ["salt", "baker's yeast"]),
        ("[]", []),
        ("broken [", None),
        (None, None),
    ],
)
def test_string_list(spark, literal, expected):
    assert one(spark, parsing.string_list(F.col("v")), literal) == expected


def test_unreadable_lists_stay_null(spark):
    for build in (parsing.ingredient_terms, parsing.step_text, parsing.tag_terms):
        assert one(spark, build(F.col("v")), "broken [") is None
        assert one(spark, build(F.col("v")), "[]") == ""
    assert one(spark, parsing.ingredient_terms(F.col("v")), "['Sea Salt', \"baker's yeast\"]") == "sea_salt baker_s_yeast"
    assert one(spark, parsing.step_text(F.col("v")), "['Mix!', 'bake it.']") == "mix bake it"
    assert one(spark, parsing.tag_terms(F.col("v")), "['30-minutes', 'Main Dish']") == "30-minutes main dish"


@pytest.mark.parametrize(
    ("literal", "expected"),
    [
        ("[1, 2.5, 3, 4, 5, 6, 7]", [1.0, 2.5, 3.0, 4.0, 5.0, 6.0, 7.0]),
        ("[1, 2]", [1.0, 2.0, None, None, None, None, None]),
        (None, [None] * 7),
    ],
)
def test_nutrition(spark, literal, expected):
    row = spark.createDataFrame([(literal,)], "v string").select(*parsing.nutrition_columns(F.col("v"))).first()
    assert list(row) == expected and list(row.asDict()) == list(parsing.NUTRITION_FIELDS)


def test_tolerant_casts(spark):
    assert one(spark, parsing.as_number(F.col("v")), "abc") is None
    assert str(one(spark, parsing.as_day(F.col("v")), "2002-01-01")) == "2002-01-01"
    assert one(spark, parsing.as_day(F.col("v")), "2002-13-01") is None
    assert one(spark, parsing.as_instant(F.col("v")), "once") is None


def test_row_key(spark):
    df = spark.createDataFrame([("u", None, "t"), ("u", "", "t"), ("u", "x", "t")], "a string, b string, c string")
    found = [r[0] for r in df.select(keys.row_key(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert found[0] == found[1] != found[2] and len(found[0]) == 64


def test_split_name(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("e"))
    for method in ("xxhash64", "md5"):
        shares = dict(
            rows.select(keys.split_name(F.col("e"), method=method).alias("s")).groupBy("s").count().collect()
        )
        assert abs(shares["train"] / 2000 - 0.8) < 0.04 and abs(shares["val"] / 2000 - 0.1) < 0.03
    assert one(spark, keys.split_name(F.col("v")), None) == "train"
    with pytest.raises(ValueError):
        keys.split_name(F.col("v"), train=0.8, val=0.1, test=0.2)
    with pytest.raises(ValueError):
        keys.unit_hash(F.col("v"), method="crc")


PAIRS = [
    ([1.0, 0.0], [1.0, 0.0], 1.0),
    ([1.0, 0.0], [0.0, 2.0], 0.0),
    ([0.0, 0.0], [1.0, 2.0], 0.0),
    ([1.0, 2.0], [1.0, 2.0, 3.0], None),
    ([1.0, None], [1.0, 2.0], None),
]


@pytest.mark.parametrize(("a", "b", "expected"), PAIRS)
def test_cosine(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    found = df.select(vectors.cosine(F.col("a"), F.col("b"))).first()[0]
    assert found == expected if expected is None else math.isclose(found, expected, abs_tol=1e-12)


def test_matrix_product_handles_every_row(spark):
    rows = [([3.0, 4.0],), ([0.0, 0.0],), (None,), ([1.0, None],), ([1.0],), ([0.0, -2.0],)]
    df = spark.createDataFrame(rows, "v array<double>").coalesce(1)
    units = vectors.unit_rows([[1.0, 0.0], [0.0, 5.0], [0.0, 0.0]])
    found = [r[0] for r in df.select(vectors.matrix_product(units, unit_input=True)(F.col("v"))).collect()]
    assert found[2] is found[3] is found[4] is None
    assert np.allclose(found[0], [0.6, 0.8, 0.0]) and found[1] == [0.0, 0.0, 0.0]
    assert np.allclose(found[5], [0.0, -1.0, 0.0])


def test_matrix_product_logistic(spark):
    df = spark.createDataFrame([([2.0],)], "v array<double>")
    score = vectors.matrix_product(np.array([[1.0], [0.0]]), bias=np.array([0.0, -np.inf]), logistic=True)
    assert np.allclose(df.select(score(F.col("v"))).first()[0], [1 / (1 + math.exp(-2)), 0.0])


def test_array_column_reads_ml_vectors(spark):
    df = spark.createDataFrame([(Vectors.dense(1.0, 2.0),), (Vectors.sparse(2, [], []),), (None,)], ["v"])
    found = [r[0] for r in df.select(vectors.array_column(df, "v")).collect()]
    assert found == [[1.0, 2.0], [0.0, 0.0], None]


def test_metric_formulas(spark):
    df = spark.createDataFrame([(2, 1, 6, 1), (0, 0, 3, 0)], "tp int, fp int, tn int, fn int")
    good, empty = metrics.with_metrics(df).collect()
    assert math.isclose(good["precision"], 2 / 3) and math.isclose(good["recall"], 2 / 3)
    assert math.isclose(good["f1"], 2 / 3) and math.isclose(good["youden_j"], 2 / 3 - 1 / 7)
    assert [empty[c] for c in ("precision", "recall", "f1", "fpr", "youden_j")] == [0.0] * 5
