"""Quality classifier of supervised subword embeddings.

A word is the mean of learned vectors of itself and of its character n-grams, all
hashed into one table; so is a pair of neighbouring words, by their shapes and by
whether the second repeats the first. A document is the mean of its words and pairs,
and a softmax layer reads it. Table and layer are trained together by stochastic
gradient descent in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import of_rows, remainder, sampled_texts, slices, teaches, text_bytes, usable_labels

#: Rows of the hashed table (a power of two), width of a vector, lengths of character n-grams.
BUCKET_BITS, WIDTH, GRAMS = 17, 8, (3, 4)
BUCKETS = 1 << BUCKET_BITS
#: Labelled rows that are learned from, at most; they are chosen by a hash of the key.
FIT_ROWS = 4000
#: Words kept in the memo of a scorer: a matter of memory, not of results.
MEMO = 300_000
SHAPES = bytes.maketrans(
    bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(48, 58)) + bytes(range(128, 256)),
    b"X" * 26 + b"x" * 26 + b"9" * 10 + b"x" * 128,
)
RUNS = re.compile(rb"(.)\1{2,}", re.DOTALL)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def shape(word: bytes) -> bytes:
    """Kinds of the letters of a word, runs shortened to two: ``Eron,`` is ``Xxx,``."""
    return RUNS.sub(rb"\1\1", word.translate(SHAPES))


def row_of(name: bytes) -> int:
    return xxhash.xxh3_64_intdigest(name) % BUCKETS


def word_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of words one after another, and how many each word has: itself, its shape, its n-grams."""
    padded = [b"<" + word + b">" for word in words]
    sizes = np.array([len(p) for p in padded])
    raw = np.frombuffer(b"".join(padded) + b"\0" * max(GRAMS), np.uint8).astype(np.uint64)
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(total)  # bytes up to the end of the word
    whole = [row_of(b"w" + word) for word in words] + [row_of(b"s" + shape(word)) for word in words]
    rows, owners = [np.array(whole, np.int64)], [np.arange(len(words)), np.arange(len(words))]
    for size in GRAMS:
        inside = np.flatnonzero(left >= size)
        gram = np.full(len(inside), size, np.uint64)
        for k in range(size):
            gram = gram << np.uint64(8) | raw[inside + k]
        rows.append(((gram * SPREAD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(owner[inside])
    owner = np.concatenate(owners)
    order = owner.argsort(kind="stable")
    return np.concatenate(rows)[order], np.bincount(owner, minlength=len(words))


class Units:
    """Numbers words and their shapes; a document is its words' numbers and its pairs' codes."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.shape_number: dict[bytes, int] = {}
        self.shapes = np.zeros(1024, np.int64)

    def clear(self) -> None:
        self.number.clear()
        self.shape_number.clear()

    def learn(self, new: list[bytes]) -> None:
        first = len(self.number)
        if first + len(new) > len(self.shapes):
            self.shapes = np.concatenate([self.shapes, np.zeros(len(self.shapes) + len(new), np.int64)])
        for k, word in enumerate(new, first):
            self.number[word] = k
            self.shapes[k] = self.shape_number.setdefault(shape(word), len(self.shape_number))

    def codes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of known words; a code for each pair of neighbours: their shapes, or a repeat and its shape."""
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        kinds = self.shapes[numbers]
        return numbers, np.where(numbers[1:] == numbers[:-1], -1, kinds[:-1]) << 32 | kinds[1:]

    def pair_rows(self, codes: np.ndarray) -> list[int]:
        names = list(self.shape_number)
        made = []
        for code in codes.tolist():
            first, second = code >> 32, names[code & 0xFFFFFFFF]
            made.append(row_of(b"p=" + second if first < 0 else b"p" + names[first] + b" " + second))
        return made


class Model(NamedTuple):
    """Collapsed for scoring: the softmax over two classes of a mean is a logistic of mean weights."""

    weights: np.ndarray  # one for each row of the table
    bias: float


def train(
    texts: list[bytes], labels: list[int], *, epochs: int = 8, batch: int = 32, rate: float = 0.5, seed: int = 1
) -> Model:
    """Learn table and softmax layer; deterministic for the same rows in the same order.

    Without rows of both classes every text scores the share of class 1 (0.5
    without rows).
    """
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    docs = [_document(raw) for raw in texts]
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, 2), np.float32)
    layer[:, 1] = rng.normal(0, 0.5, WIDTH)
    layer[:, 0] = -layer[:, 1]
    bias = np.log(np.array([1 - share, share], np.float32))
    squares = np.full(BUCKETS, 1e-6, np.float32)
    truth = np.array(labels)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for some in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // batch)):
            sizes = [len(docs[k][0]) for k in some]
            owner = np.repeat(np.arange(len(some)), sizes)
            at = np.concatenate([docs[k][0] for k in some])
            weight = np.concatenate([docs[k][1] for k in some])
            vectors = table[at]
            means = np.stack([np.bincount(owner, weight * vectors[:, j], len(some)) for j in range(WIDTH)], 1)
            scores = means @ layer + bias
            odds = np.exp(scores - scores.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            error[np.arange(len(some)), truth[some]] -= 1
            back = (error @ layer.T).astype(np.float32)
            rows, inverse = np.unique(at, return_inverse=True)
            gradient = np.stack([np.bincount(inverse, weight * back[owner, j], len(rows)) for j in range(WIDTH)], 1)
            squares[rows] += (gradient**2).mean(1)
            table[rows] -= step * gradient / np.sqrt(squares[rows])[:, None]
            layer -= 0.1 * step * (means.T @ error).astype(np.float32) / len(some)
            bias -= 0.1 * step * error.mean(0).astype(np.float32)
    return Model(table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def _document(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of a document and the share of each in its mean."""
    words = raw.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    units = Units()
    different = list(dict.fromkeys(words))
    units.learn(different)
    numbers, codes = units.codes(words)
    rows, sizes = word_rows(different)
    shares = np.repeat(np.bincount(numbers, minlength=len(different)) / sizes, sizes)
    codes, counts = np.unique(codes, return_counts=True)
    at, inverse = np.unique(np.concatenate([rows, np.array(units.pair_rows(codes), np.int64)]), return_inverse=True)
    shares = np.concatenate([shares, counts]) / (2 * len(words) - 1)
    return at.astype(np.int32), np.bincount(inverse, shares, len(at)).astype(np.float32)


class Scorer:
    """Probability of class 1 for texts; words and pairs through bounded memos."""

    def __init__(self, model: Model):
        self.model, self.units = model, Units()
        self.words = np.zeros(MEMO + 1, np.float64)
        self.pairs: dict[int, float] = {}

    def _learn(self, words: set[bytes]) -> None:
        new = words.difference(self.units.number)
        if len(self.units.number) + len(new) > MEMO:
            self.units.clear()
            self.pairs.clear()
            new = words
            if len(new) > len(self.words):
                self.words = np.zeros(len(new), np.float64)
        if new:
            some, first = list(new), len(self.units.number)
            rows, sizes = word_rows(some)
            sums = np.add.reduceat(self.model.weights[rows].astype(np.float64), np.cumsum(sizes) - sizes)
            self.words[first : first + len(some)] = sums / sizes
            self.units.learn(some)

    def score(self, texts: list[bytes]) -> list[float]:
        split = [raw.split() for raw in texts]
        self._learn(set(chain.from_iterable(split)))
        made = []
        for words in split:
            mean = 0.0
            if words:
                numbers, codes = self.units.codes(words)
                codes, counts = np.unique(codes, return_counts=True)
                listed = codes.tolist()
                new = [code for code in listed if code not in self.pairs]
                if new:
                    rows = self.units.pair_rows(np.array(new))
                    self.pairs.update(zip(new, self.model.weights[rows].tolist(), strict=True))
                pairs = np.array([self.pairs[code] for code in listed])
                mean = (self.words[numbers].sum() + (pairs * counts).sum()) / (2 * len(words) - 1)
            made.append(float(1 / (1 + np.exp(-np.clip(mean + self.model.bias, -40, 40)))))
        return made


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, *, key: str, text: str, label: str) -> Model:
    """Train on at most ``FIT_ROWS`` labelled rows, in one task; only the model reaches the driver.

    Rows that are held out, have a null key or label, or a label other than 0
    and 1, are not learned from.
    """
    known = of_rows(usable_labels(labels, label, held_out, key), docs, key)
    rows = sampled_texts(docs, known, FIT_ROWS, key=key, text=text)

    def run(table: pa.Table) -> pa.Table:
        drawn = sorted(zip(table.column("t").to_pylist(), table.column("y").to_pylist(), strict=True))
        model = train([t for t, _ in drawn], [y for _, y in drawn])
        return pa.table({"w": pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), "b": [model.bias]})

    made = rows.withColumn("g", F.lit(0)).groupBy("g").applyInArrow(run, "w binary, b double").first()
    return Model(np.frombuffer(made["w"], "<f4"), made["b"]) if made else train([], [])


def score(
    docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """(key, score, predicted), one row per input row: probability of label 1 for each whole text. No shuffle.

    Null and empty texts, and texts of white space, score what the model knows
    without any word. Nothing but the text enters a score.
    """
    columns = docs.select(F.col(key).alias("k"), text_bytes(text).alias("t"))
    kind = columns.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches):
            made = pa.array(scorer.score(batch.column(1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["k", "score"])

    scored = columns.mapInArrow(run, f"k {kind}, score double")
    return scored.select(F.col("k").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 4, fold: int = 2, threshold: float = 0.7,
) -> DataFrame:
    """(key, held_out, score, predicted): learn from the labels of all folds but one, score every text.

    A key's fold is its crc32 as text modulo ``folds``. An empty table gives an
    empty result; without usable labels every text scores 0.5.
    """
    model = fit(docs, labels, remainder(key, folds) == fold, key=key, text=text, label=label)
    scored = score(docs, model, key=key, text=text, threshold=threshold)
    return scored.select(key, (remainder(key, folds) == fold).alias("held_out"), "score", "predicted")


def keep(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 4, fold: int = 2, threshold: float = 0.7,
) -> DataFrame:
    """The rows whose text is predicted to have label 1, all columns, without a join.

    Where the labels of these rows do not hold both classes nothing can be learned, and all rows stay.
    """
    held_out = remainder(key, folds) == fold
    if not teaches(of_rows(usable_labels(labels, label, held_out, key), docs, key)):
        return docs
    model = fit(docs, labels, held_out, key=key, text=text, label=label)
    at = docs.schema.names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in slices(batches):
            raw = [(x or "").encode() for x in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([x >= threshold for x in scorer.score(raw)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
