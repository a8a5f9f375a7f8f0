"""Language models against their definition, and predictions on held-out and odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.llm import language
from tagloom.llm.catalog import QUERIES


class SlowModel:
    """Interpolated Kneser-Ney over dictionaries, as the definition reads."""

    def __init__(self, counts):
        self.times = [defaultdict(int) for _ in range(4)]
        before = [defaultdict(set) for _ in range(4)]
        for word, n in counts.items():
            line = "^^^" + word + "$"
            for at in range(3, len(line)):
                for k in range(4):
                    gram = line[at - k : at + 1]
                    self.times[k][gram] += n
                    before[k][gram].add(line[at - k - 1] if at > k else "")
        for k in range(3):
            for gram in self.times[k]:
                if not gram.startswith("^"):
                    self.times[k][gram] = len(before[k][gram])
        self.cuts = [language.discounts(np.array(list(t.values()))) for t in self.times]
        self.alphabet = {gram for gram in self.times[0]}

    def chance(self, gram):
        """Of the last symbol behind the others."""
        k = len(gram) - 1
        if k < 0:
            return 1 / language.ALPHABET
        context = gram[:-1]
        same = {g: n for g, n in self.times[k].items() if g[:-1] == context}
        if not same:
            return self.chance(gram[1:])
        total = sum(same.values())
        cut = self.cuts[k]
        left = sum(cut[min(n, 3)] for n in same.values()) / total
        n = self.times[k].get(gram, 0)
        return (n - cut[min(n, 3)]) / total + left * self.chance(gram[1:])

    def bits(self, word):
        line = "^^^" + word + "$"
        return -sum(math.log2(self.chance(line[at - 3 : at + 1])) for at in range(3, len(line)))


def bits(model, words):
    codes, sizes = language.symbols(words)
    return model.bits(codes, language.gram_hashes(codes), sizes)


@settings(max_examples=40, deadline=None)
@given(
    st.dictionaries(st.text(alphabet="abcé漢", min_size=1, max_size=6), st.integers(1, 9), min_size=1, max_size=25),
    st.lists(st.text(alphabet="abcdé漢\U00020000", min_size=1, max_size=9), min_size=1, max_size=8),
)
def test_model_by_definition(counts, words):
    model, slow = language.fit_model(Counter(counts)), SlowModel(counts)
    assert np.allclose(bits(model, words), [slow.bits(w) for w in words], rtol=1e-4, atol=1e-4)


def test_chances_sum_to_one():
    rng = random.Random(2)
    counts = Counter("".join(rng.choice("aabc") for _ in range(rng.randint(1, 7))) for _ in range(300))
    slow = SlowModel(counts)
    for context in ("^^^", "^^a", "abc", "zzz", "cab"):
        seen = sum(slow.chance(context + x) for x in slow.alphabet)
        assert seen + (language.ALPHABET - len(slow.alphabet)) * slow.chance(context + "q") == pytest.approx(1.0)


def test_arrays_are_sorted():
    model = language.fit_model(Counter(["one", "two", "three", "one"]))
    assert all((np.diff(t.keys.astype(object)) > 0).all() for t in [*model.grams, *model.contexts])


def slow_words(text):
    return re.findall(r"[^\W\d_]+", text.lower())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="abé", min_size=1, max_size=30), min_size=1, max_size=9), min_size=1, max_size=12), st.sampled_from([1, 700, 1 << 20]))
def test_memo_changes_nothing(texts, room):
    models = [language.fit_model(Counter({"abba": 3, "baé": 2})), language.fit_model(Counter({"é": 2, "bb": 1}))]
    identifier = language.Identifier(["x", "y"], models)
    reader = language.Reader(identifier, room)
    for at in range(0, len(texts), 3):
        group = [Counter(words) for words in texts[at : at + 3]]
        for counts, (found, size) in zip(group, reader.bits(group), strict=True):
            assert size == sum(len(w) + 1 for w in counts.elements())
            assert np.allclose(found, [sum(bits(m, list(counts.elements()))) for m in models])
        assert len(reader.places) <= reader.room and len(reader.known) <= reader.room
        assert all(len(w) <= language.MEMO_WORD for w in reader.places)


LANGUAGES = {"aa": ["kala", "kalla", "lakka", "alka"], "bb": ["stro", "strop", "prost", "trops"], "": ["mimi", "nimi", "minim"]}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(12)
    rows = []
    for k in range(400):
        name = rng.choice(list(LANGUAGES))
        rows.append((k, " ".join(rng.choices(LANGUAGES[name], k=rng.randint(1, 40))), name, "clash", 1.0, 2))
    rows += [(500 + k, "kala kala kalla", "aa", "x", 0.0, 0) for k in range(300)]  # copies
    rows += [(None, None, "aa", "x", 0.0, 0), (900, "1234 !!", "bb", "x", 0.0, 0), (901, "", "aa", "x", 0.0, 0), (902, "kala", None, "x", 0.0, 0)]
    rows += [(903, "漢字テスト" * 40, None, "x", 0.0, 0), (904, "kala " * 60_000, None, "x", 0.0, 0), (904, "kala", None, "x", 0.0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, t string, score double, h int").repartition(5)


def test_predictions(labelled):
    rows = labelled.collect()
    found = language.classify(labelled).collect()
    assert len(found) == len(rows)
    known = {r["doc_id"]: r["lang"] for r in rows}
    for r in found:
        if r["doc_id"] in (None, 900, 901):
            assert (r["lang_pred"], r["score"], r["rejected"], r["cross_entropy"]) == ("und", 0.0, True, None)
        elif r["doc_id"] in (902, 904):
            assert r["lang_pred"] == "aa"
        elif r["doc_id"] == 903:
            assert r["rejected"] and r["lang_pred"] in LANGUAGES
        else:
            assert r["lang_pred"] == known[r["doc_id"]]
        assert 0.0 <= r["score"] <= 1.0
    copies = {(r["lang_pred"], r["score"]) for r in found if r["doc_id"] is not None and 500 <= r["doc_id"] < 800}
    assert len(copies) == 1


def test_held_out_rows_teach_nothing(labelled):
    held = labelled.filter("crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 4 = 2")
    changed = labelled.join(held.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(held.withColumn("lang", F.lit("zz")))
    one, two = (sorted(map(tuple, language.classify(x).collect()), key=repr) for x in (labelled, changed))
    assert [r for r in one if r[0] is not None] == [r for r in two if r[0] is not None]


def test_nothing_to_learn(spark, odd, nothing):
    assert language.classify(nothing.withColumn("lang", F.lit("x"))).collect() == []
    found = language.classify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(found) == odd.count() and {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}


def test_one_language(spark, odd):
    found = language.classify(odd.withColumn("lang", F.lit("x"))).collect()
    assert {r["lang_pred"] for r in found} == {"x", "und"}
    blank = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert blank == {1, 2, 8}


def test_sample_is_bounded(spark):
    rows = spark.range(20_000).select(F.lit("x").alias("lang"), F.concat(F.lit("word number "), "id").cast("binary").alias("t"))
    taken = language.sample(rows, 20_000, 1 << 30, 5)
    size = taken.agg(F.sum(F.octet_length("t"))).first()[0]
    assert 10_000 < size < 30_000
    many = rows.withColumn("lang", F.concat(F.lit("l"), (F.hash("t") % 50).cast("string")))
    assert language.sample(many, 1 << 20, 1 << 20, 7).select("lang").distinct().count() == 7


def test_texts_meet_in_bounded_groups():
    import pyarrow as pa

    texts = [b"x" * (3 << 20), b"y" * (3 << 20), None, b"z"] + [b"w"] * 1000
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["t"])
    made = list(language.text_groups([batch]))
    assert [t for b in made for t in b.column(0).to_pylist()] == texts
    assert [b.num_rows for b in made][:2] == [1, language.SLICE]


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op12_language"](spark, folder)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(docs.select("doc_id", "lang", F.col("text").rlike(r"\p{L}").alias("letters")), "doc_id").collect()
    assert len(rows) == docs.count()
    right = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"] and r["letters"]]
    assert sum(right) / len(right) > 0.98
    assert all((r["lang_pred"] == "und") == (not r["letters"]) for r in rows)
