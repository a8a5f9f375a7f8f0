"""Word vectors against dense counts and a dense factorisation."""

from __future__ import annotations

import random
import uuid
from collections import Counter
from functools import partial
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import packed, parts, text_features
from tagloom.operators import word_vectors as wv
from tagloom.operators.text_features import embed_by_join, nearest_words
from tagloom.sources import storage
from tagloom.sources.storage import forget, materialise

LETTERS = [f"w{k}" for k in range(30)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    rows = []
    for _ in range(250):
        topic = LETTERS[rng.randrange(3) * 10 :][:10]
        rows.append([rng.choice(topic if rng.random() < 0.8 else LETTERS) for _ in range(rng.randint(0, 25))])
    rows += [["rare", "w1"], ["w2", None, "w3"], [], None, ["w4"], ["w5"] * 6]
    return rows


@pytest.fixture(scope="module")
def df(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, t array<string>").repartition(6)


SPEC = wv.FactorSpec(tokens="t", window=3, min_count=3, size=40, passes=1, oversample=4)


def dense(texts, window=3, min_count=3):
    frequent = {w for w, n in Counter(w for t in texts for w in t or [] if w).items() if n >= min_count}
    counts: Counter = Counter()
    for t in texts:
        for i, a in enumerate(t or []):
            for j, b in enumerate(t):
                if i != j and abs(i - j) <= window and a in frequent and b in frequent:
                    counts[a, b] += 1
    own: Counter = Counter()
    for (a, _), n in counts.items():
        own[a] += n
    total = sum(counts.values())
    return counts, {(a, b): log(n * total / (own[a] * own[b])) for (a, b), n in counts.items()}


def test_counts_and_weights(df, texts):
    counts, pmi = dense(texts)
    pairs = wv.cooccurrences(df, SPEC)
    assert {(r["word"], r["context"]): r["n"] for r in pairs.collect()} == dict(counts)
    found = {(r["word"], r["context"]): r["pmi"] for r in wv.positive_pmi(pairs).collect()}
    assert found.keys() == {pair for pair, x in pmi.items() if x > 0}
    assert all(abs(x - pmi[pair]) < 1e-12 for pair, x in found.items())


def weights_matrix(texts):
    _, pmi = dense(texts)
    words = sorted({a for a, _ in pmi})
    place = {w: k for k, w in enumerate(words)}
    made = np.zeros((len(words), len(words)))
    for (a, b), x in pmi.items():
        made[place[a], place[b]] = max(x, 0.0)
    return words, made


@pytest.mark.parametrize("blocks", [{}, {"block_words": 7, "part_entries": 1}])
def test_whole_factorisation_is_exact(spark, df, texts, blocks, monkeypatch):
    """With more columns than words the vectors' products are those of the dense matrix, in one block or many."""
    words, matrix = weights_matrix(texts)
    if blocks:
        monkeypatch.setattr(wv, "packed_weights", _many_parts(wv.packed_weights))
    spec = wv.FactorSpec(tokens="t", min_count=3, size=40, oversample=4, passes=1, exponent=1.0, **blocks)
    found = {r["word"]: np.array(r["vector"]) for r in wv.corpus_vectors(df, spec).collect()}
    assert sorted(found) == [w for w, row in zip(words, matrix) if row.any()]
    stacked = np.array([found.get(w, np.zeros(40)) for w in words])
    assert np.allclose(stacked @ stacked.T, matrix @ matrix, atol=1e-9)


def _many_parts(plain):
    """Four slices a block, which the rule would make only for many weights."""

    def packed(weighed, words, spec):
        class Few:
            @staticmethod
            def count():
                return 1

        return plain(weighed, Few, wv.FactorSpec(part_entries=40))

    return packed


def test_leading_directions(df, texts):
    """Fewer columns than words: singular values and similarities close to those of the dense factorisation."""
    words, matrix = weights_matrix(texts)
    spec = wv.FactorSpec(tokens="t", min_count=3, size=3, oversample=10, passes=6)
    found = {r["word"]: np.array(r["vector"]) for r in wv.corpus_vectors(df, spec).collect()}
    left, values, _ = np.linalg.svd(matrix)
    exact = left[:, :3] * np.sqrt(values[:3])
    made = np.array([found[w] for w in words])
    assert np.allclose((made**2).sum(axis=0), values[:3], rtol=1e-4)
    assert np.allclose(made @ made.T, exact @ exact.T, atol=1e-3)


def test_layout_does_not_matter(df):
    spec = wv.FactorSpec(tokens="t", min_count=3, size=5, passes=2)
    one, two = ({r["word"]: r["vector"] for r in wv.corpus_vectors(x, spec).collect()} for x in (df, df.coalesce(1)))
    assert one.keys() == two.keys()
    assert all(np.allclose(one[w], two[w], atol=1e-8) for w in one)


def test_vectors_serve_neighbours_and_documents(df):
    vectors = wv.corpus_vectors(df, wv.FactorSpec(tokens="t", min_count=3, size=6))
    near = [r["word"] for r in nearest_words(vectors, "w3", 5).collect()]
    assert sum(int(w[1:]) < 10 for w in near) >= 4  # words of its own topic
    rows = embed_by_join(df, vectors, key="id", tokens="t", out="v", size=6).collect()
    assert len(rows) == df.count() and all(len(r["v"]) == 6 for r in rows)


def test_nothing_to_count(spark):
    none = spark.createDataFrame([(1, []), (2, ["a"]), (3, None), (4, ["a", "b"])], "id int, t array<string>")
    assert wv.cooccurrences(none, SPEC).collect() == []
    assert wv.corpus_vectors(none, SPEC).collect() == []
    assert wv.positive_pmi(wv.cooccurrences(none.limit(0), SPEC)).collect() == []


@pytest.fixture
def many_parts(monkeypatch):
    """Parts of about 200 tokens, dealt row by row."""
    monkeypatch.setattr(parts, "RUN_BITS", 0)
    for module in (wv, text_features):
        monkeypatch.setattr(module, "with_words", partial(parts.with_words, part_tokens=200))


def test_pairs_and_sums_of_many_parts(spark, df, texts, many_parts):
    """Pairs and document vectors do not depend on the parts; repeated keys add up, null keys have zeros."""
    counts, _ = dense(texts)
    assert {(r["word"], r["context"]): r["n"] for r in wv.cooccurrences(df, SPEC).collect()} == dict(counts)
    vectors = spark.createDataFrame([(w, [float(k), 1.0]) for k, w in enumerate(LETTERS[:20])], "word string, vector array<double>")
    rows = df.unionByName(spark.createDataFrame([(3, ["w1", "w9", "w29"]), (None, ["w1"])], df.schema))
    held: Counter = Counter()
    for row in rows.collect():
        for w in row["t"] or []:
            if row["id"] is not None and w in LETTERS[:20]:
                held[row["id"]] += np.array([float(w[1:]), 1.0])
    found = embed_by_join(rows, vectors, key="id", tokens="t", out="v", size=2).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        wanted = held[r["id"]] / len(r["t"]) if r["t"] and r["id"] in held else np.zeros(2)
        assert np.allclose(r["v"], wanted, atol=1e-12)


def test_a_part_meets_each_of_its_words_once(spark):
    """What moves are the words of a part, not one for each word of each row."""
    words = [f"w{k}" for k in range(50)]
    rows = spark.createDataFrame([(k, words) for k in range(400)], "id int, t array<string>").coalesce(1)
    table = spark.createDataFrame([(w,) for w in words], "word string")
    met = parts.with_words(rows, "t", table, ["id"], part_tokens=10_000)
    found = {r["kind"]: r["count"] for r in met.groupBy("kind").count().collect()}
    assert found[1] == 400 and found[0] <= 2 * 50


def test_dealt_rows_are_the_same_in_more_tasks(spark):
    rows = spark.range(0, 4000, 1, 1).select((F.col("id") % 7).alias("x"))
    small = text_features.dealt(rows, 4000)
    sizes = [r["count"] for r in small.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 1000
    assert small.columns == ["x"] and sorted(r["x"] for r in small.collect()) == sorted(k % 7 for k in range(4000))


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for values in (np.array([], int), np.array([0, 127, 128, 2**14, 2**35, 2**62]), rng.integers(0, 2**20, 5000)):
        line, ends = packed.packed(values)
        back, same_ends = packed.unpacked(line.tobytes())
        assert back.tolist() == values.tolist() and same_ends.tolist() == ends.tolist()
        assert packed.risen(packed.rising(np.sort(values))).tolist() == np.sort(values).tolist()
    assert len(packed.packed(np.arange(128))[0]) == 128


def scratch_bytes(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    return tmp_path


def test_pairs_leave_little_on_the_disk(spark, scratch):
    """Counting and weighing pairs leaves packed pairs and words behind, not strings and not copies of the tokens."""
    rng = np.random.default_rng(3)
    rows = [(k, [f"word{n:04}" for n in (rng.random(60) ** 3 * 900).astype(int)]) for k in range(1500)]
    df = materialise(spark.createDataFrame(rows, "id int, t array<string>"), "tokens")
    before = scratch_bytes(scratch)
    weighed = wv.positive_pmi(wv.cooccurrences(df, wv.FactorSpec(tokens="t", min_count=5)))
    counted = weighed.count()
    assert counted > 50_000 and scratch_bytes(scratch) - before < counted


def test_written_tables_can_be_forgotten(spark, scratch):
    made = materialise(spark.range(10))
    assert scratch_bytes(scratch) > 0
    forget(made)
    assert scratch_bytes(scratch) == 0
    forget(spark.range(3))  # not a written table: nothing happens


def test_pairs_of_any_table_are_weighed(spark, df, texts):
    """A table of pairs that did not come from ``cooccurrences`` gives the same weights."""
    plain = materialise(wv.cooccurrences(df, SPEC))
    wanted = {(r["word"], r["context"]): (r["n"], r["pmi"]) for r in wv.positive_pmi(wv.cooccurrences(df, SPEC)).collect()}
    found = {(r["word"], r["context"]): (r["n"], r["pmi"]) for r in wv.positive_pmi(plain).collect()}
    assert found.keys() == wanted.keys()
    assert all(found[k][0] == n and abs(found[k][1] - x) < 1e-12 for k, (n, x) in wanted.items())


def test_large_vectors_are_dealt_over_sets(spark, df, texts, monkeypatch):
    """Vectors beyond the bytes of a task meet the rows set by set; sums are the same."""
    vectors = spark.createDataFrame([(w, [float(k), 1.0]) for k, w in enumerate(LETTERS[:20])], "word string, vector array<double>")
    whole = {r["id"]: r["v"] for r in embed_by_join(df, vectors, key="id", tokens="t", out="v", size=2).collect()}
    monkeypatch.setattr(text_features, "VECTOR_BYTES", 100)
    parts_ = {r["id"]: r["v"] for r in embed_by_join(df, vectors, key="id", tokens="t", out="v", size=2).collect()}
    assert whole.keys() == parts_.keys() and all(np.allclose(whole[k], parts_[k], atol=1e-12) for k in whole)


def test_sums_of_a_vector_table_can_be_forgotten(spark, df, scratch):
    """What a transform writes is known, so a plan can delete it once its own table is stored."""
    vectors = spark.createDataFrame([(w, [float(k), 1.0]) for k, w in enumerate(LETTERS)], "word string, vector array<double>")
    table = text_features.VectorTable(vectors, "t", "v", 2, "id")
    before = len(list(scratch.iterdir()))
    assert table.transform(df).count() == df.count() and len(list(scratch.iterdir())) == before + 1
    forget(*table.written)
    assert len(list(scratch.iterdir())) == before


def test_words_in_several_rows_of_a_batch_add_up():
    """Sums by products, for words with many pairs, and by ranges, for few, are those of a plain loop."""
    rng = np.random.default_rng(2)
    for words in (3, 400):
        row, context = np.sort(rng.integers(0, words, 5000)), rng.integers(0, 50, 5000)
        weight, vectors = rng.random(5000), rng.normal(size=(50, 4))
        sums, met, wanted = np.zeros((words, 4)), np.zeros(words, bool), np.zeros((words, 4))
        wv._add(sums, met, row, context, weight, vectors)
        np.add.at(wanted, row, weight[:, None] * vectors[context])
        assert np.allclose(sums, wanted) and set(np.flatnonzero(met)) == set(row)
