"""Classifiers by held-out accuracy, language models against slow versions of themselves."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tagloom.llm import attention, lm, quality, toxicity
from tagloom.llm.catalog import QUERIES
from tagloom.llm.common import remainder

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def fold(key, of: int) -> int:
    return zlib.crc32(("" if key is None else str(key)).encode()) % of


def auc(rows) -> float:
    ones = [s for s, y in rows if y == 1]
    zeros = [s for s, y in rows if y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


def held_out(spark, folder: str, name: str, label: str) -> list[tuple[float, int, int]]:
    rows = QUERIES[name](spark, folder).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label)
    return [(r["score"], r[label], r["predicted"]) for r in rows.join(labels, "doc_id").collect()]


def test_quality_on_held_out_rows(spark):
    rows = held_out(spark, "/root/testdata/sf0.01", "op3_subword_quality", "quality")
    assert auc([r[:2] for r in rows]) > 0.98
    assert np.mean([p == y for _, y, p in rows]) > 0.95


def test_toxicity_on_held_out_rows(spark):
    rows = held_out(spark, "/root/testdata/sf0.1", "op8_kneser_ney", "toxic")
    assert auc([r[:2] for r in rows]) > 0.95
    assert np.mean([p == y for _, y, p in rows]) > 0.95


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(4, 1, 0, "t", 1), (5, 0, 1, "t", 2), (5, 1, 0, "t", 3), (3, 0, 1, "t", 4), (12, 1, 0, "t", 5), (None, 1, 1, "t", 6), (10, None, None, "t", 7), (1, 7, -1, "t", 8)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, t string, y int")


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_odd_documents(spark, odd, nothing, labels, module):
    folds = {quality: (4, 2), toxicity: (5, 0)}[module]
    made = module.classify(odd, labels).collect()
    keys = [r["doc_id"] for r in odd.collect()]
    assert Counter((r["doc_id"], r["held_out"]) for r in made) == Counter((k, fold(k, folds[0]) == folds[1]) for k in keys)
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in made)
    by_key = defaultdict(set)
    for r in made:
        by_key[r["doc_id"]].add(r["score"])
    assert by_key[4] == by_key[5] and by_key[1] == by_key[2]
    kept = module.keep(odd, labels)
    assert kept.columns == odd.columns
    names = {r["doc_id"] for r in made if (r["predicted"] == 1) == (module is quality)}
    assert {r["doc_id"] for r in kept.collect()} == names
    assert module.classify(nothing, labels).collect() == module.keep(nothing, labels).collect() == []
    blank = module.classify(odd, labels.limit(0)).collect()
    assert {r["score"] for r in blank} == {0.5}


def test_quality_scorer_equals_document_means():
    texts = [b"", b"One one ONE two, two,", b"a b a b " * 40, "é漢 x!! X!! " .encode() * 9, b"q" * 500 + b" r"]
    model = quality.train([b"good words in a line", b"BAD!! BAD!! BAD!!"] * 20, [1, 0] * 20, epochs=3)
    made = quality.Scorer(model).score(texts)
    for raw, score in zip(texts, made, strict=True):
        rows, shares = quality._document(raw)
        assert score == pytest.approx(1 / (1 + np.exp(-(model.weights[rows] @ shares + model.bias))), abs=1e-5)
        assert len(rows) == 0 or shares.sum() == pytest.approx(1, abs=1e-4)
    assert quality.Scorer(model).score([b"good words in a line"])[0] > 0.8 > 0.2 > quality.Scorer(model).score([b"BAD!! BAD!!"])[0]


def slow_ratio(texts, labels, discount, first, second) -> float:
    """Log ratio of the second word after the first, straight from the formulas."""
    pairs, triples = (defaultdict(set), defaultdict(set)), (defaultdict(set), defaultdict(set))
    union, words = set(), {b"\n"}
    for raw, c in zip(texts, labels, strict=True):
        line = [b"\n", b"\n", *[toxicity.clean(w) for w in raw.lower().split()]]
        words |= set(line)
        for u, h, w in zip(line, line[1:], line[2:], strict=False):
            pairs[c][w].add(h)
            triples[c][h, w].add(u)
            union.add((h, w))
    shared = (sum(w == second for _, w in union) + 1) / (len(union) + len(words) + 1)
    chance = []
    for c in (0, 1):
        total = sum(map(len, pairs[c].values()))
        left = sum(min(len(x), discount) for x in pairs[c].values()) / total
        uni = max(len(pairs[c][second]) - discount, 0) / total + left * shared
        own = [len(x) for (h, _), x in triples[c].items() if h == first]
        more = toxicity.PAIR_FACTOR * discount
        back = sum(min(n, more) for n in own) / sum(own) if own else 1.0
        chance.append((max(len(triples[c][first, second]) - more, 0) / sum(own) if own else 0.0) + back * uni)
    return float(np.log(chance[1] / chance[0]))


def test_kneser_ney_by_definition():
    rng = random.Random(3)
    texts, labels = [], []
    for k in range(60):
        words = [rng.choice("abcdefgh") for _ in range(30)] + ["x", "y"] * (3 if k % 2 else 1)
        rng.shuffle(words)
        texts.append(" ".join(words).encode())
        labels.append(k % 2)
    ratios = toxicity.kneser_ney(toxicity.counted(texts, labels), 0.75)
    scorer = toxicity.Scorer(ratios)
    for text in (b"a b c x y, X y", b"y y q a", b"new a"):
        words = [b"\n", *[toxicity.clean(w) for w in text.lower().split()]]
        made = scorer.per_word(scorer._numbers([text])[0])
        wanted = [slow_ratio(texts, labels, 0.75, a, b) for a, b in zip(words, words[1:], strict=False)]
        assert made == pytest.approx(wanted, abs=1e-9)
    assert len(ratios.pairs)


def test_copies_of_a_text_add_nothing():
    texts, labels = [b"one of these words stands here", b"and other words there"], [1, 0]
    once = toxicity.kneser_ney(toxicity.counted(texts, labels), 0.75)
    often = toxicity.kneser_ney(toxicity.counted([texts[0]] * 50 + texts[1:], [1] * 50 + [0]), 0.75)
    assert once.words == often.words
    assert np.allclose(once.base, often.base)


@pytest.fixture(scope="module")
def fitted():
    rng = random.Random(1)
    texts = [[rng.choice([b"the", b"of", b"house", b"gardens", "été".encode()]) for _ in range(rng.randint(0, 70))] for _ in range(30)]
    subwords = attention.Subwords(VOCABULARY)
    return texts, subwords, attention.fit_sample(texts, subwords, steps=40)


def slow_chances(model, subwords, ids: np.ndarray) -> tuple[list[float], list[float]]:
    """Chance of each id and of starting a word, one window at a time, with the weights as they are."""
    e, p, wq, wk, wv, wo, u, b = (np.asarray(w, float) for w in model.weights)
    step = attention.WINDOW - attention.OVERLAP
    line = np.concatenate([[subwords.end], ids, [subwords.end]])
    mass = np.array([(10.0 ** model.rest * subwords.starts)[model.named == n].sum() for n in range(attention.NAMED)])
    chances, starts = [], []
    for target in range(1, len(line)):
        first = (target - 1) // step * step - attention.OVERLAP
        x = np.array([e[line[max(k, 0)]] + p[k - first] for k in range(first, target)])
        weight = (x[-1] @ wq) @ (x @ wk).T / np.sqrt(attention.WIDTH)
        weight = np.exp(weight - weight.max())
        h = x[-1] + weight / weight.sum() @ (x @ wv) @ wo
        z = np.exp(h @ u + b)
        z /= z.sum()
        name = model.named[line[target]]
        chances.append(np.log10(z[name]) + model.rest[line[target]])
        starts.append(np.log10(z @ mass))
    return chances, starts


def test_batched_windows_equal_single_ones(fitted):
    texts, subwords, model = fitted
    ids = subwords.ids(texts)
    for own, (chance, start) in list(zip(ids, attention.Scorer(model, subwords).score(ids), strict=True))[:6]:
        slow = slow_chances(model, subwords, own)
        assert chance == pytest.approx(slow[0], abs=1e-4)
        assert start == pytest.approx(slow[1], abs=1e-4)


def test_every_id_has_a_chance_of_its_own_in_context(fitted):
    texts, subwords, _ = fitted
    counts = np.bincount(np.concatenate(subwords.ids(texts)), minlength=subwords.size)
    model = attention.start_model(counts, subwords)
    assert model.inner.out.shape == (attention.WIDTH, subwords.size)
    assert all(len(set(subwords.starts[model.named == n])) == 1 for n in range(attention.NAMED))
    model = attention.fit_sample(texts, subwords, model=model, steps=40)
    scorer = attention.Scorer(model, subwords)
    rare = np.flatnonzero(counts == 0)[:40]
    pairs = [(a, b) for a, b in zip(rare, rare[1:], strict=False) if model.named[a] == model.named[b]]
    gaps = []
    for head in (300, 5000):
        made = scorer.score([np.array([head, k]) for pair in pairs for k in pair])
        gaps += [one[1] - two[1] for (one, _), (two, _) in zip(made[::2], made[1::2], strict=True)]
    assert len(gaps) > 10 and len(np.unique(np.round(gaps, 5))) == len(gaps)  # not shares of a class, whatever stands before
    ends = scorer.score([np.array([300, k]) for k in range(subwords.end)])
    total = sum(10.0 ** chance[1] for chance, _ in ends) + 10.0 ** scorer.score([np.array([300])])[0][0][1]
    assert total == pytest.approx(1, abs=1e-3)


def test_inner_gradient_by_differences(fitted):
    texts, subwords, _ = fitted
    rng = np.random.default_rng(1)
    model = attention.start_model(np.ones(subwords.size, int), subwords)
    slots, bounds = model.layout()
    inputs, targets = rng.integers(0, subwords.size, (2, 3, attention.WINDOW))
    parts = [w.astype(float) for w in model.parts()]

    def loss_at(parts):
        m = model.of(parts)
        return attention.gradients(m.weights, inputs, model.named[targets], m.inner, bounds, slots[targets])

    _, slope = loss_at(parts)
    for k, spot in ((0, (inputs[0, 0], 3)), (5, (2, 4)), (8, (3, slots[targets[0, 0]])), (9, (slots[targets[1, 1]],))):
        losses = []
        for move in (1e-4, -1e-4):
            changed = [w.copy() for w in parts]
            changed[k][spot] += move
            losses.append(loss_at(changed)[0])
        assert slope[k][spot] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=2e-2, abs=2e-5)


def test_words_cut_side_by_side_equal_single_ones():
    subwords, rng = attention.Subwords(VOCABULARY), random.Random(3)
    letters = [x for x in range(256) if not bytes([x]).isspace()]
    words = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 2 * attention.SHORT))).lower() for _ in range(300)]
    words += [b"the", b"t", "été".encode(), b"house" * 9, b"\x00\xff", b"gardens", b"the"]
    assert subwords.spelled(words) == [subwords.cut(word) for word in words]
    assert subwords.spelled([]) == []
    sizes = subwords.cuts([b"the", b"gardens"])[1]
    assert sizes.tolist() == [len(subwords.cut(word)) // 2 for word in (b"the", b"gardens")]


def slow_descent(model, batches, rate: float, steps: int) -> np.ndarray:
    """Adam as it is written, over all weights at once, in double precision."""
    slots, bounds = model.layout()
    line = model.flat().astype(float)
    first = second = np.zeros_like(line)
    for step, windows in enumerate(batches, 1):
        targets = windows[:, 1:]
        now = model.on(line)
        _, made = attention.gradients(now.weights, windows[:, :-1], now.named[targets], now.inner, bounds, slots[targets])
        slope = np.concatenate([g.ravel() for g in made])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        pace = rate * (1 - 0.9 * min(1.0, step / steps))
        line = line - pace * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return line


def test_weights_moved_in_parts_equal_plain_adam(fitted):
    _, subwords, _ = fitted
    rng = np.random.default_rng(4)
    model = attention.start_model(rng.integers(0, 50, subwords.size), subwords)
    batches = [rng.integers(0, subwords.size, (70, attention.WINDOW + 1)) for _ in range(3)]  # more rows than stand together
    assert 70 * attention.WINDOW > 2 * attention.ROWS
    made, slow = attention.descend(model, batches, 1e-3, 10).flat(), slow_descent(model, batches, 1e-3, 10)
    moved = slow - model.flat()
    assert np.abs(made - slow).mean() < 1e-3 * np.abs(moved).mean()
    steep = model.of([w * 40 for w in model.parts()])  # scores whose exp float32 does not hold
    loss, slope = attention.gradients(steep.weights, batches[0][:, :-1], model.named[batches[0][:, 1:]])
    assert np.isfinite(loss) and all(np.isfinite(g).all() for g in slope)


def slow_inner_chances(model, subwords, ids: np.ndarray) -> list[float]:
    """``slow_chances`` of a model with an output for each id."""
    e, p, wq, wk, wv, wo, u, b = (np.asarray(w, float) for w in model.weights)
    slots, bounds = model.layout()
    step = attention.WINDOW - attention.OVERLAP
    line = np.concatenate([[subwords.end], ids, [subwords.end]])
    chances = []
    for target in range(1, len(line)):
        first = (target - 1) // step * step - attention.OVERLAP
        x = np.array([e[line[max(k, 0)]] + p[k - first] for k in range(first, target)])
        weight = np.exp((x[-1] @ wq) @ (x @ wk).T / np.sqrt(attention.WIDTH))
        h = x[-1] + weight / weight.sum() @ (x @ wv) @ wo
        name, slot = model.named[line[target]], slots[line[target]]
        z, own = np.exp(h @ u + b), slice(bounds[name], bounds[name + 1])
        inner = np.exp(h @ model.inner.out[:, own].astype(float) + model.inner.bias[own])
        chances.append(np.log10(z[name] / z.sum()) + np.log10(inner[slot - bounds[name]] / inner.sum()))
    return chances


def test_batched_chances_of_ids_equal_single_ones(fitted):
    texts, subwords, _ = fitted
    ids = subwords.ids(texts)
    counts = np.bincount(np.concatenate(ids), minlength=subwords.size)
    model = attention.fit_sample(texts, subwords, model=attention.start_model(counts, subwords), steps=20)
    made = attention.Scorer(model, subwords).score(ids)  # more rows than stand together
    assert sum(len(own) for own in ids) > attention.ROWS
    for own, (chance, _) in list(zip(ids, made, strict=True))[::9]:
        assert chance == pytest.approx(slow_inner_chances(model, subwords, own), abs=1e-4)


def test_training_walks_over_whole_texts():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 900, n) for n in (0, 1, 31, 32, 33, 2000, 7)]
    batches = list(attention.training_batches(iter(texts), 999, 16))
    assert {len(x) for x in batches[:-1]} == {16} and 0 < len(batches[-1]) <= 16
    windows = [tuple(x) for x in np.concatenate(batches)]
    learned = {pair for x in windows for pair in zip(x[k : k + 2] for k in range(attention.WINDOW))}
    for text in texts:
        line = [999, *text.tolist(), 999]
        assert all((tuple(line[k : k + 2]),) in learned for k in range(len(line) - 1))  # behind its true left neighbour
        count = -(-(len(text) + 1) // attention.WINDOW)
        assert sum(set(x) <= {999, *line} for x in windows) >= count
    assert len(windows) == sum(-(-(len(x) + 1) // attention.WINDOW) for x in texts)


def test_the_tail_of_a_text_moves_the_weights(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "FIT_ROWS", 1)
    head = "the house of gardens " * 60
    for tail in ("river " * 40, "bridge " * 40):
        docs = spark.createDataFrame([(1, "a"), (2, head + tail)], "doc_id bigint, text string").coalesce(1)
        counts = np.ones(attention.RANKS + 1, int)
        seen.append(lm.train(docs, counts, VOCABULARY, key="doc_id", text="text").flat())
    assert not np.allclose(seen[0], seen[1])


def test_classes_follow_the_counts_of_all_texts(spark, monkeypatch):
    rows = [(k, "alpha beta" if k < 30 else "gamma gamma") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    subwords = attention.Subwords(VOCABULARY)
    ids = subwords.ids([t.encode().split() for _, t in rows])
    wanted = np.bincount(np.concatenate([*ids, np.full(60, subwords.end)]), minlength=subwords.size)
    made = lm.id_counts(lm.word_counts(docs), 60, VOCABULARY)
    assert (made == wanted).all()
    monkeypatch.setattr(lm, "FIT_ROWS", 1)
    model = lm.train(docs, made, VOCABULARY, key="doc_id", text="text")
    assert (model.rest == attention.start_model(wanted, subwords).rest).all() and model.inner


def test_gradient_by_differences(fitted):
    _, subwords, model = fitted
    rng = np.random.default_rng(0)
    inputs = rng.integers(0, subwords.size, (3, attention.WINDOW))
    targets = rng.integers(0, attention.NAMED, (3, attention.WINDOW))
    weights = attention.Weights(*(w.astype(float) for w in model.weights))
    _, slope = attention.gradients(weights, inputs, targets)
    for k, name in enumerate(weights._fields):
        spot = tuple(rng.integers(0, n) for n in weights[k].shape)
        spot = (inputs[0, 0], *spot[1:]) if name == "embed" else spot
        losses = []
        for move in (1e-4, -1e-4):
            changed = weights[k].copy()
            changed[spot] += move
            losses.append(attention.gradients(weights._replace(**{name: changed}), inputs, targets)[0])
        assert slope[k][spot] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=2e-2, abs=2e-5)


def test_training_lowers_the_loss(fitted):
    texts, subwords, model = fitted
    flat = attention.fit_sample([], subwords)
    score = [sum(x.sum() for x in attention.Scorer(m, subwords).words(texts)) for m in (flat, model)]
    assert score[1] > score[0]


def slow_base(rows) -> dict:
    learned = [r["text"] for r in rows if fold(r["doc_id"], 5) != 1]
    counts = Counter(w for t in learned for w in (t or "").encode().lower().split())
    tokens = sum(counts.values()) + len(learned)
    types = len(counts) + 1
    made = Counter()
    for r in rows:
        words = (r["text"] or "").encode().lower().split()
        base = sum(np.log10((counts[w] + 0.5) / (tokens + 0.5 * (types + 1))) for w in words)
        base += np.log10((len(learned) + 0.5) / (tokens + 0.5 * (types + 1)))
        known = sum(w in counts for w in words) + 1
        made[r["doc_id"], fold(r["doc_id"], 5) == 1, len(words) + 1, known, tokens, round(float(base), 4)] += 1
    return made


def figures(rows) -> Counter:
    return Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows)


def test_scores_of_odd_documents(odd, nothing, monkeypatch):
    made = lm.score_folds(odd, VOCABULARY).collect()
    assert figures(made) == slow_base(odd.collect())
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in made)
    monkeypatch.setattr(lm, "FREQUENT", 0)  # every word through the join
    joined = {(r["doc_id"], r["n_tokens"]): r["score"] for r in lm.score_folds(odd, VOCABULARY).collect()}
    assert joined == pytest.approx({(r["doc_id"], r["n_tokens"]): r["score"] for r in made}, rel=1e-9)
    assert lm.score_folds(nothing, VOCABULARY).collect() == []
    unlearned = lm.score(odd, F.lit(False), VOCABULARY).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in unlearned} == {(0, 0, 0.0)}


def test_scores_beat_the_base_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op2_attention_lm"](spark, folder).collect()
    assert figures(rows) == slow_base(spark.read.parquet(f"{folder}/documents.parquet").collect())
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > 0.95 * sum(r["base_score"] for r in out)


def test_remainder_is_crc32_of_the_key_as_text(spark):
    rows = spark.createDataFrame([(5,), (-7,), (None,)], "doc_id bigint")
    assert [r[0] for r in rows.select(remainder("doc_id", 4)).collect()] == [fold(k, 4) for k in (5, -7, None)]
