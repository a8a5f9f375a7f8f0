"""Near-duplicate operators, sketches and links against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.llm import graph, links, simhash, sketches, vectors
from tagloom.llm.catalog import QUERIES, URL_RULES


def roots(nodes, pairs) -> dict:
    """Smallest node of each component, by union and find."""
    above = {n: n for n in nodes}

    def find(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            above[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def slow_fingerprint(text: str, size: int = 4) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + size]), 42) for k in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(keys, prints) -> list:
    pairs = [(a, b) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 4]
    root = roots(set(prints), pairs)
    least: dict = {}
    for key, p in zip(keys, prints, strict=True):
        if key is not None:
            least[root[p]] = min(least.get(root[p], key), key)
    return [least.get(root[p]) for p in prints]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    random.Random(1).shuffle(chain)
    star = [(7, k) for k in range(200, 230)]
    pairs = [*chain, *star, (1, 1), (3, 2), (2, 3), (None, 5), (160, 7)]
    found = graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    usable = [(a, b) for a, b in pairs if a is not None and a != b]
    assert {r["node"]: r["component"] for r in found} == roots({n for p in usable for n in p}, usable)
    assert len(found) == len({r["node"] for r in found})
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB \n\té漢", max_size=80), st.integers(1, 5))
def test_fingerprint_by_definition(text, size):
    assert simhash.fingerprint(text.encode(), size) & (1 << 64) - 1 == slow_fingerprint(text, size)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.integers(0, 4), st.randoms(use_true_random=False))
def test_spanning_links_connect_what_is_close(centres, spread, rng):
    members = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, spread + 1))) for c in centres for _ in range(5)}
    members = sorted(m & (1 << 64) - 1 for m in members)
    made = simhash.spanning_links(np.array(members, np.uint64).view(np.int64), 4)
    assert len(made) < len(members)
    plain = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in made]
    close = [(a, b) for a in members for b in members if a < b and (a ^ b).bit_count() <= 4]
    assert roots(members, plain) == roots(members, close)


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_every_close_pair_shares_a_key(spark, blocks):
    rng = random.Random(blocks)
    pairs = []
    for _ in range(40):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        pairs.append((np.int64(np.uint64(a)).item(), np.int64(np.uint64(b)).item()))
    rows = spark.createDataFrame(pairs, "a bigint, b bigint")
    shared = rows.select(simhash.F.arrays_overlap(simhash.block_keys("a", blocks, 4), simhash.block_keys("b", blocks, 4)).alias("x"))
    assert all(r["x"] for r in shared.collect())


@pytest.mark.parametrize("part", [4, 8192])
def test_simhash_of_near_copies(spark, prose, monkeypatch, part):
    """Small parts make every larger key a hot one, dealt over tiles."""
    monkeypatch.setattr(simhash, "PART", part)
    rows = spark.createDataFrame(list(enumerate(prose)), "doc_id bigint, text string").repartition(4)
    found = {r["doc_id"]: r for r in simhash.near_duplicates(rows).collect()}
    prints = [slow_fingerprint(t) for t in prose]
    assert [found[k]["fingerprint"] & (1 << 64) - 1 for k in range(len(prose))] == prints
    assert [found[k]["component_id"] for k in range(len(prose))] == slow_components(range(len(prose)), prints)


def test_simhash_of_odd_documents(odd, nothing):
    rows = odd.select("doc_id", "text").collect()
    keys, prints = [r["doc_id"] for r in rows], [slow_fingerprint(r["text"] or "") for r in rows]
    wanted = sorted(zip(keys, prints, slow_components(keys, prints), strict=True), key=str)
    made = simhash.near_duplicates(odd).collect()
    assert sorted(((r["doc_id"], r["fingerprint"] & (1 << 64) - 1, r["component_id"]) for r in made), key=str) == wanted
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    named = sorted({k for k, _, c in wanted if k is not None and k == c})
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == named
    assert kept.filter("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(nothing).collect() == simhash.keep_one(nothing).collect() == []


def test_one_row_of_each_group_whatever_its_key(spark):
    one, two, three = ("a first text about rivers and bridges", "some other words on cats and dogs here", "a third line that nobody else has written")
    rows = [(3, one, "a"), (5, one, "b"), (5, two, "c"), (5, three, "d"), (5, three, "e"), (None, two, "f"), (None, "quite alone without any key", "g"), (None, "quite alone without any key", "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string").coalesce(1)
    for order in (docs, docs.orderBy(F.desc("row")).coalesce(1)):
        left = simhash.keep_one(order).select("doc_id", "text").collect()
        assert sorted(map(tuple, left), key=str) == sorted([(3, one), (5, two), (5, three), (None, rows[-1][1])], key=str)
    assert {r["row"] for r in simhash.keep_one(docs).collect()} == {"a", "c", "d", "g"}


def test_simhash_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    rows = QUERIES["op4_simhash"](spark, folder).orderBy("doc_id").collect()
    keys, prints = [d["doc_id"] for d in docs], [slow_fingerprint(d["text"] or "") for d in docs]
    assert [r["fingerprint"] for r in rows] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in rows] == slow_components(keys, prints)


def edited(texts: list[str]) -> list[str]:
    following = [*texts[1:], *texts[:1]]
    return [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following, strict=True)]


def test_sketches_of_odd_documents(odd, nothing):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    texts = [t for _, t in rows]
    made = sketches.compare_edited(odd).collect()
    own = [sketches.sketch(t.encode()) for t in texts]
    changed = [sketches.sketch(t.encode()) for t in edited(texts)]
    wanted = [
        (k, len(t), hashlib.sha256(e.encode()).hexdigest(), sketches.written(a), sketches.written(b), sketches.containment(a, b), sketches.containment(a, c))
        for (k, t), e, a, b, c in zip(rows, edited(texts), own, changed, [*own[1:], own[0]], strict=True)
    ]
    assert sorted(map(tuple, made), key=str) == sorted(wanted, key=str)
    plain = sketches.with_sketch(odd).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in plain) == sorted((str(k), sketches.written(a)) for (k, _), a in zip(rows, own, strict=True))
    assert sketches.compare_edited(nothing).collect() == sketches.with_sketch(nothing).collect() == []


def test_sketch_query_orders_by_key(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    texts = [d["text"] or "" for d in docs]
    rows = QUERIES["op9_scaled_sketch"](spark, folder).orderBy("doc_id").collect()
    assert [r["edited_sha256"] for r in rows] == [hashlib.sha256(t.encode()).hexdigest() for t in edited(texts)]
    assert [r["n_chars"] for r in rows] == [len(t) for t in texts]
    near = pd.DataFrame([r.asDict() for r in rows])
    assert near["near_edited"].mean() > 0.4 > 0.05 > near["near_next"].mean()
    for a in rows:
        assert sketches.containment(sketches.parsed(a["fingerprint"]), sketches.parsed(a["edited_fingerprint"])) == a["near_edited"]


def test_sketch_estimates_containment_and_merges():
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(8000)]
    small, large = " ".join(words[:1000]).encode(), " ".join(words).encode()
    assert sketches.containment(sketches.sketch(small), sketches.sketch(large)) == 1
    half = " ".join(words[:500] + [f"x{k}" for k in range(500)]).encode()
    assert abs(sketches.containment(sketches.sketch(half), sketches.sketch(large)) - 0.5) < 0.15
    other = " ".join(f"y{k}" for k in range(3000)).encode()
    together = sketches.merge([sketches.sketch(large), sketches.sketch(other)])
    assert set(sketches.sketch(large)) | set(sketches.sketch(other)) == set(together)
    assert len(sketches.sketch(b"")) == 0 and len(sketches.sketch(b"word")) == 1
    assert sketches.containment(sketches.sketch(b""), sketches.sketch(b"")) == 1


VECTORS = "vec_id bigint, embedding array<float>, label int, k string, v int, n int, c int"


def vector_rows(count: int = 300, dims: int = 16) -> list[tuple]:
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, dims))
    rows = []
    for k in range(count):
        x = (centres[k % 30] + rng.normal(0, rng.choice([0.0, 0.05, 0.3]), dims)).astype(np.float32)
        rows.append((k, x.tolist(), k % 2 if k % 30 > 5 else 0, "x", 1, 2, 3))
    rows += [(900, None, 1), (901, [0.0] * dims, 1), (902, [None] + [1.0] * (dims - 1), 1), (903, [float("nan")] * dims, 1)]
    rows += [(904, [float("inf")] * dims, 0), (905, rows[0][1], None), (906, rows[0][1][:8], 0), (907, [], 0), (None, rows[0][1], 0), (5, rows[5][1], rows[5][2])]
    return [(*r, *(["x", 1, 2, 3] if len(r) == 3 else [])) for r in rows]


def slow_links(rows: list[tuple]) -> list[tuple]:
    usable = []
    for key, x, label, *_ in rows:
        good = label is not None and x and all(e is not None and np.isfinite(e) for e in x) and any(x)
        usable.append(np.array(x, float) / np.linalg.norm(np.array(x, float)) if good else None)
    pairs = []
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            x, y = usable[a], usable[b]
            if x is not None and y is not None and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y >= 0.98:
                pairs.append((a, b))
    root = roots(range(len(rows)), pairs)
    least: dict = {}
    for k, row in enumerate(rows):
        if row[0] is not None:
            least[root[k]] = min(least.get(root[k], row[0]), row[0])
    degree = np.bincount(np.array(pairs, int).ravel(), minlength=len(rows))
    return [(r[0], int(degree[k]), least.get(root[k]), r[0] == least.get(root[k])) for k, r in enumerate(rows)]


@pytest.mark.parametrize(("part", "per_cell"), [(2048, 32), (5, 4)])
def test_multi_index_equals_brute_force(spark, monkeypatch, part, per_cell):
    """Small parts deal every cell over tiles; small cells make vectors meet as guests."""
    monkeypatch.setattr(vectors, "PART", part)
    monkeypatch.setattr(vectors, "PER_CELL", per_cell)
    rows = vector_rows()
    made = vectors.near_duplicates(spark.createDataFrame(rows, VECTORS).repartition(3), recall=0.9999).collect()
    assert sorted(map(tuple, made), key=str) == sorted(slow_links(rows), key=str)


def test_multi_index_without_usable_rows(spark):
    rows = spark.createDataFrame([(1, None, 1, "x", 1, 1, 1), (2, [1.0], None, "x", 1, 1, 1)], VECTORS)
    assert sorted(map(tuple, vectors.near_duplicates(rows).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert vectors.near_duplicates(rows.limit(0)).collect() == []


def test_multi_index_recall_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    unit = np.array(table["embedding"].tolist(), float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    wanted = {}
    for label in table["label"].unique():
        own = np.flatnonzero(table["label"] == label)
        wanted |= dict(zip(table["vec_id"].to_numpy()[own], (unit[own] @ unit[own].T >= 0.98).sum(1) - 1, strict=True))
    made = {r["vec_id"]: r["n_links"] for r in QUERIES["op10_multi_index"](spark, folder).collect()}
    assert made.keys() == wanted.keys()
    assert all(made[k] <= n for k, n in wanted.items())
    assert sum(made.values()) >= 0.99 * sum(wanted.values())


def slow_place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]


def slow_rule(host, path):
    fitting = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.name), default=None)


PAGES = [
    (1, "http://a.org/x", '<a href="http://b.org/">b</a> <a HREF=//C.org>c</a>'),
    (2, "http://b.org/y?z", '<a href="https://a.org/">a</a>'),
    (3, "http://bad.net/es/1", '<a href="http://d.org/q">d</a>'),
    (4, "http://e.org/", '<a href="http://bad.net/es/2">!</a>'),
    (5, "http://good.com/", '<a href="http://a.org/">a</a><a href="/local">l</a>'),
    (6, None, "<a href='http://a.org'>a</a>"),
    (7, "no scheme", None),
    (8, "HTTP://WWW.Example.COM/en/1#f", ""),
    (8, "HTTP://WWW.Example.COM/en/1#f", ""),
    (None, "http://x.example.com/en/?a", None),
    (9, "http://é漢.org?q=://a.com/", "x" * 100_000),
    (10, "http://good.com", None),
]


def test_url_rules_and_trust(spark):
    rows = [(*p, "h", "r", 1.0) for p in PAGES]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, rule string, trust double")
    made = links.judge(table, URL_RULES, rounds=200).collect()
    assert len(made) == len(PAGES)
    # dense version of the propagation
    hosts = sorted({"a.org", "b.org", "c.org", "bad.net", "d.org", "e.org", "good.com", "www.example.com", "x.example.com"})
    at = {h: k for k, h in enumerate(hosts)}
    moves = np.zeros((len(hosts), len(hosts)))
    for a, b in (("a.org", "b.org"), ("a.org", "c.org"), ("b.org", "a.org"), ("bad.net", "d.org"), ("e.org", "bad.net"), ("good.com", "a.org")):
        moves[at[a], at[b]] += 1
    votes = {"allow": np.zeros(len(hosts)), "block": np.zeros(len(hosts))}
    for _, url, _ in PAGES:
        host, path = slow_place(url)
        rule = slow_rule(host, path)
        if rule:
            votes[rule.verdict][at[host]] += 1
    ranks = {}
    for verdict, matrix in (("allow", moves), ("block", moves.T)):
        seed = votes[verdict] / votes[verdict].sum()
        share = matrix / np.maximum(matrix.sum(1, keepdims=True), 1)
        rank = seed.copy()
        for _ in range(300):
            sent = 0.85 * rank @ share
            rank = sent + seed * (1 - sent.sum())
        ranks[verdict] = rank
    wanted = []
    for key, url, _ in PAGES:
        host, path = slow_place(url)
        rule = slow_rule(host, path)
        k = at.get(host)
        bad = k is not None and ranks["block"][k] > 0.5 * (ranks["allow"][k] + ranks["block"][k])
        wanted.append((key, host, path, rule.name if rule else None, rule.verdict if rule else ("block" if bad else "allow")))
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in made]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    for r in made:
        if r["rule"] is None and r["host"] in at and r["trust"] is not None:
            assert abs(r["trust"] - ranks["allow"][at[r["host"]]]) < 1e-4
            assert abs(r["distrust"] - ranks["block"][at[r["host"]]]) < 1e-4
    assert {r["page_id"]: r["verdict"] for r in made}[4] == "block"
    assert links.judge(table.limit(0), URL_RULES).collect() == []


def test_url_query_rules(spark, folder):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op7_link_trust"](spark, folder).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        host, path = slow_place(pages[r["page_id"]])
        rule = slow_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.name)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


def test_wide_vectors_and_many_centroids_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(4)
    books = (rng.normal(size=(1024, 384)), rng.normal(size=(1024, 384)))
    unit = rng.normal(size=(512, 768))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    grid = vectors.Grid(books, 0.01)
    tracemalloc.start()
    made = grid.margins(unit)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    for (own, gap), book, half in zip(made, books, (unit[:, :384], unit[:, 384:]), strict=True):
        far = ((half[:20, None] - book[None]) ** 2).sum(2)
        assert (own[:20] == far.argmin(1)).all()
        apart = np.sqrt(((book[own[:20], None] - book[None]) ** 2).sum(2))
        exact = (far - far.min(1, keepdims=True)) / (2 * np.maximum(apart, 1e-9))
        exact[np.arange(20), own[:20]] = 0.0
        assert np.allclose(gap[:20], exact**2)
