"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary texts.

Both count an expression by how many different words precede it, so copies of a
text add nothing. They discount their counts and give what they discount to one
shared distribution: how many different words each word follows in either class. An
expression too rare to outlive the discount weighs the same in both, and only what
one class really prefers tells them apart. Log-likelihoods are compared per word,
over the whole text and in those windows of a few words where toxic ones are likeliest.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import of_rows, remainder, sampled_texts, slices, teaches, text_bytes, unknown, usable_labels

#: Labelled rows of each class that are learned from, at most; they are chosen by a hash of the key.
FIT_ROWS = 3000
#: One in so many of them calibrates the score and is not counted.
CALIBRATE = 4
#: Words of the windows compared.
WINDOWS = (1, 3, 12)
#: What may be taken off each count; the one that calibrates best is taken.
DISCOUNTS = (0.75, 1.5, 3.0, 6.0, 12.0, 24.0)
#: How many times that is taken off the count of a pair.
PAIR_FACTOR = 4
#: How firmly the weights of the comparisons are held to zero.
HOLD = 0.1
MEMO = 300_000
EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
START = b"\n"


def clean(word: bytes) -> bytes:
    """A word without marks around it; marks alone stay."""
    return word.strip(EDGES) or word


class Ratios(NamedTuple):
    """What is left of the two models: log ratios, toxic to ordinary."""

    words: dict[bytes, int]  # numbers of the words that outlive the discount in either class
    base: np.ndarray  # ratio of each word's probability after an unseen one; last: any other word
    after: np.ndarray  # ratio of the backoff weights behind each word; last: any other word
    pairs: np.ndarray  # codes of the pairs that outlive the discount, ascending
    pair: np.ndarray  # ratio of the second word's probability after the first


class Model(NamedTuple):
    ratios: Ratios
    weights: np.ndarray  # of the highest window of each length, of the whole text, and the offset


class Counts(NamedTuple):
    """Numbers of different predecessors of words and of pairs, by class."""

    names: list[bytes]
    classes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # pairs, n of words, pairs followed, n of pairs


def counted(texts: list[bytes], labels: list[int]) -> Counts:
    number: dict[bytes, int] = {START: 0}
    rows = []
    for raw in texts:
        words = [clean(w) for w in raw.lower().split()]
        for word in dict.fromkeys(words):
            number.setdefault(word, len(number))
        rows.append(np.fromiter(chain((0, 0), map(number.__getitem__, words)), np.int64, len(words) + 2))
    size = len(number)
    truth = np.array(labels)
    classes = []
    for c in (0, 1):
        docs = [rows[k] for k in np.flatnonzero(truth == c)]
        flat = np.concatenate([*docs, np.zeros(2, np.int64)])
        pairs = np.unique(flat[:-1] * size + flat[1:])
        pairs = pairs[pairs % size > 0]
        lead = np.unique(flat[:-2] * size + flat[1:-1])
        triples = np.unique(np.searchsorted(lead, flat[:-2] * size + flat[1:-1]) * size + flat[2:])
        triples = triples[triples % size > 0]
        codes, times = np.unique(lead[triples // size] % size * size + triples % size, return_counts=True)
        classes.append((pairs, np.bincount(pairs % size, minlength=size), codes, times))
    return Counts(list(number), classes)


def kneser_ney(counts: Counts, discount: float) -> Ratios:
    """Interpolated Kneser-Ney of both classes down to a shared lowest order.

    P_c(w) = max(n_c(w) - D, 0) / N_c + l_c S(w) and
    P_c(w | h) = max(n_c(h, w) - E, 0) / n_c(h) + l_c(h) P_c(w). n_c(w) and
    n_c(h, w) are numbers of different words before w and before h w in class c,
    N_c and n_c(h) their sums, l the share that the discount (D, or E for pairs)
    took. S(w) is the share of the different pairs of both classes that end in
    w, where every word and the unknown word get one more.
    """
    names, per_class = counts
    size, pair_discount = len(names), PAIR_FACTOR * discount
    union = np.union1d(per_class[0][0], per_class[1][0])
    shared = (np.bincount(union % size, minlength=size) + 1) / (len(union) + size + 1)
    unigram, spread = [], []
    for _, n, _, _ in per_class:
        total = max(1, n.sum())
        left = np.minimum(n, discount).sum() / total if n.sum() else 1.0
        spread.append(left)
        unigram.append(np.maximum(n - discount, 0) / total + left * shared)
    base = np.log(unigram[1] / unigram[0])
    lost, firsts = [], []
    for _, _, codes, times in per_class:
        firsts.append(np.bincount(codes // size, times, size))
        lost.append(np.bincount(codes // size, np.minimum(times, pair_discount), size))
    weight = [np.where(f > 0, x / np.maximum(f, 1), 1.0) for x, f in zip(lost, firsts, strict=True)]
    strong = np.unique(np.concatenate([codes[times > pair_discount] for _, _, codes, times in per_class]))
    first, second = strong // size, strong % size
    likely = []
    for c, (_, _, codes, times) in enumerate(per_class):
        at = np.minimum(np.searchsorted(codes, strong), max(0, len(codes) - 1))
        n = np.where(codes[at] == strong, times[at], 0) if len(codes) else np.zeros(len(strong))
        likely.append(np.maximum(n - pair_discount, 0) / np.maximum(firsts[c][first], 1) + weight[c][first] * unigram[c][second])
    ratio = np.log(likely[1] / likely[0])
    alive = np.maximum(per_class[0][1], per_class[1][1]) > discount
    alive[first] = alive[second] = True
    alive[0] = True
    new = np.cumsum(alive) - 1
    kept = np.flatnonzero(alive)
    other = float(np.log(spread[1] / spread[0]))
    after = np.log(weight[1] / weight[0])
    pairs = new[first] << 32 | new[second]
    return Ratios(
        {names[k]: int(new[k]) for k in kept}, np.append(base[kept], other), np.append(after[kept], 0.0), pairs, ratio
    )


class Scorer:
    """Log-likelihood ratios of texts."""

    def __init__(self, ratios: Ratios):
        self.ratios = ratios
        self.known: dict[bytes, int] = {}
        self.seconds = np.zeros(len(ratios.base), bool)
        self.firsts = np.zeros(len(ratios.base), bool)
        self.firsts[ratios.pairs >> 32] = True
        self.seconds[ratios.pairs & 0xFFFFFFFF] = True

    def _numbers(self, texts: list[bytes]) -> list[np.ndarray]:
        split = [raw.lower().split() for raw in texts]
        wanted = set(chain.from_iterable(split))
        get, other = self.ratios.words.get, len(self.ratios.base) - 1
        for word in unknown(self.known, wanted, MEMO):
            self.known[word] = get(clean(word), other)
        return [np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)) for words in split]

    def per_word(self, numbers: np.ndarray) -> np.ndarray:
        """Log ratio of each word after the one before it."""
        ratios = self.ratios
        before = np.concatenate([[0], numbers[:-1]])
        made = ratios.base[numbers] + ratios.after[before]
        maybe = np.flatnonzero(self.firsts[before] & self.seconds[numbers])
        if len(maybe):
            codes = before[maybe] << 32 | numbers[maybe]
            at = np.minimum(np.searchsorted(ratios.pairs, codes), len(ratios.pairs) - 1)
            found = ratios.pairs[at] == codes
            made[maybe[found]] = ratios.pair[at[found]]
        return made

    def compare(self, texts: list[bytes]) -> np.ndarray:
        """For each text: log ratio per word in its highest window of each length, and over the whole text.

        A text shorter than a window is a window; without words all are zero.
        """
        made = np.zeros((len(texts), len(WINDOWS) + 1))
        for k, numbers in enumerate(self._numbers(texts)):
            if len(numbers):
                sums = np.concatenate([[0.0], np.cumsum(self.per_word(numbers))])
                spans = [min(window, len(numbers)) for window in WINDOWS]
                made[k] = [*((sums[n:] - sums[:-n]).max() / n for n in spans), sums[-1] / len(numbers)]
        return made


def calibrate(compared: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 50):
    """Logistic regression on the comparisons by Newton's method, lightly held to zero; its weights and loss."""
    inputs = np.column_stack([compared, np.ones(len(compared))])
    beta = np.zeros(inputs.shape[1])

    def loss(b: np.ndarray) -> float:
        odds = inputs @ b
        return float(weights @ (np.logaddexp(0, odds) - labels * odds) + 0.5 * HOLD * b @ b)

    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ beta, -30, 30)))
        slope = inputs.T @ (weights * (labels - chance)) - HOLD * beta
        bend = (inputs * (weights * chance * (1 - chance))[:, None]).T @ inputs + HOLD * np.eye(len(beta))
        move = np.linalg.solve(bend, slope)
        step = 1.0
        while step > 1e-6 and loss(beta + step * move) > loss(beta):
            step /= 2
        beta = beta + step * move
        if np.abs(step * move).max() < 1e-6:
            break
    return beta, loss(beta)


def train(texts: list[bytes], labels: list[int], weights: list[float]) -> Model:
    """Count most texts, calibrate on the others. With one class only, or none, every text scores its share."""
    truth, weight = np.array(labels, int), np.array(weights, float)
    if len(set(labels)) < 2:
        share = (truth.sum() + 0.5) / (len(truth) + 1)
        flat = [0.0] * (len(WINDOWS) + 1)
        return Model(kneser_ney(counted([], []), DISCOUNTS[0]), np.array([*flat, np.log(share / (1 - share))]))
    aside = np.zeros(len(texts), bool)
    for c in (0, 1):
        aside[np.flatnonzero(truth == c)[CALIBRATE - 1 :: CALIBRATE]] = True
    if len(set(truth[aside])) < 2:
        aside[:] = False
    used = np.flatnonzero(aside) if aside.any() else np.arange(len(texts))
    learned = [k for k in range(len(texts)) if not aside[k]]
    counts = counted([texts[k] for k in learned], [labels[k] for k in learned])
    best = None
    for discount in DISCOUNTS:
        ratios = kneser_ney(counts, discount)
        compared = Scorer(ratios).compare([texts[k] for k in used])
        weights, loss = calibrate(compared, truth[used], weight[used])
        if best is None or loss < best[0]:
            best = loss, Model(ratios, weights)
    return best[1]


def chance(scorer: Scorer, weights: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Probability that each text is toxic."""
    inputs = np.column_stack([scorer.compare(texts), np.ones(len(texts))])
    return 1 / (1 + np.exp(-np.clip(inputs @ weights, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, *, key: str, text: str, label: str) -> Model:
    """Train on at most ``FIT_ROWS`` labelled rows of each class, in one task; only the model reaches the driver.

    The sample's classes are weighed by how often they are labelled. Rows that
    are held out, have a null key or label, or a label other than 0 and 1, are
    not learned from.
    """
    known = of_rows(usable_labels(labels, label, held_out, key), docs, key)
    sizes = dict(known.groupBy("y").count().collect())
    rows = [sampled_texts(docs, known.filter(F.col("y") == c), FIT_ROWS, key=key, text=text) for c in (0, 1)]

    def run(table: pa.Table) -> pa.Table:
        drawn = sorted(zip(table.column("y").to_pylist(), table.column("t").to_pylist(), strict=True))
        drawn.sort(key=lambda row: xxhash.xxh3_64_intdigest(row[1]))
        y = [row[0] for row in drawn]
        share = {c: sizes.get(c, 0) / max(1, y.count(c)) for c in (0, 1)}
        model = train([row[1] for row in drawn], y, [share[c] for c in y])
        return pa.table({"m": pa.array([pickle.dumps(model)], pa.binary())})

    drawn = rows[0].unionByName(rows[1]).withColumn("g", F.lit(0))
    made = drawn.groupBy("g").applyInArrow(run, "m binary").first()
    return pickle.loads(made["m"]) if made else train([], [], [])


def score(
    docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = 0.5
) -> DataFrame:
    """(key, score, predicted), one row per input row: probability that each whole text is toxic. No shuffle.

    Null and empty texts, and texts of white space, score what the model knows
    without any word. Nothing but the text enters a score.
    """
    columns = docs.select(F.col(key).alias("k"), text_bytes(text).alias("t"))
    kind = columns.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.ratios)
        for batch in slices(batches):
            made = pa.array(chance(scorer, model.weights, batch.column(1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["k", "score"])

    scored = columns.mapInArrow(run, f"k {kind}, score double")
    return scored.select(F.col("k").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    folds: int = 5, fold: int = 0, threshold: float = 0.5,
) -> DataFrame:
    """(key, held_out, score, predicted): learn from the labels of all folds but one, score every text.

    A key's fold is its crc32 as text modulo ``folds``. An empty table gives an
    empty result; without usable labels every text scores 0.5.
    """
    model = fit(docs, labels, remainder(key, folds) == fold, key=key, text=text, label=label)
    scored = score(docs, model, key=key, text=text, threshold=threshold)
    return scored.select(key, (remainder(key, folds) == fold).alias("held_out"), "score", "predicted")


def keep(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    folds: int = 5, fold: int = 0, threshold: float = 0.5,
) -> DataFrame:
    """The rows whose text is not predicted toxic, all columns, without a join.

    Where the labels of these rows do not hold both classes nothing can be learned, and all rows stay.
    """
    held_out = remainder(key, folds) == fold
    if not teaches(of_rows(usable_labels(labels, label, held_out, key), docs, key)):
        return docs
    model = fit(docs, labels, held_out, key=key, text=text, label=label)
    at = docs.schema.names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.ratios)
        for batch in slices(batches):
            raw = [(x or "").encode() for x in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(chance(scorer, model.weights, raw) < threshold))

    return docs.mapInArrow(run, docs.schema)
