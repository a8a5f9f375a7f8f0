"""Ranked lexical search against the formula written out, and against its SQL."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import database, differences

from tagloom.llm import lexical
from tagloom.llm.catalog import QUERIES, SQL


def slow_terms(text) -> list[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def slow_search(docs, items, top=10) -> list[tuple]:
    """Every item against every document, by the formula."""
    terms = [slow_terms(text) for _, text in docs]
    n_docs, length = sum(map(bool, terms)), sum(map(len, terms))
    held = Counter(t for x in terms for t in set(x))
    wanted: dict = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(slow_terms(text))
    rows = []
    for item, query in wanted.items():
        found = []
        for (key, _), words in zip(docs, terms, strict=True):
            counts, score = Counter(words), 0
            for t in query & counts.keys():
                m = 100 - 90 + (90 * len(words) * n_docs) // length
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += w * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        rows += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found, key=lambda x: x[:3])[:top], 1)]
    return sorted(rows, key=repr)


def got(df) -> list[tuple]:
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


ITEMS = [(1, "The quick fox, again"), (2, None), (3, "!!"), (4, "漢字 é É"), (None, "word7 word9 WORD9"), (4, "z lazy"), (5, "absent"), (6, "x")]


@pytest.fixture(scope="module")
def items(spark):
    rows = [(*row, "clash", 3, 1.0, 9) for row in ITEMS]
    return spark.createDataFrame(rows, "item_id bigint, text string, t string, k int, s double, p int")


def plain(odd) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in odd.collect()]


def test_odd_rows_by_the_formula(odd, items):
    assert got(lexical.search(odd, items)) == slow_search(plain(odd), ITEMS)
    assert got(lexical.search(odd, items, top=1)) == slow_search(plain(odd), ITEMS, 1)


def test_many_automata_give_the_same(odd, items):
    assert got(lexical.search(odd, items, block_bytes=40)) == slow_search(plain(odd), ITEMS)


def test_prose_with_ties(spark, prose):
    docs = [(k, text) for k, text in enumerate([*prose, *prose])]
    items = [(k, text) for k, text in enumerate(prose[:7])]
    made = lexical.search(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    assert got(made) == slow_search(docs, items)


def test_empty_tables(odd, items, nothing):
    assert got(lexical.search(nothing, items)) == []
    assert got(lexical.search(odd, items.limit(0))) == []
    assert got(lexical.search(odd.filter("text = ''"), items)) == []


def test_text_keys(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "x")], "item_id string, text string")
    assert [r["doc_id"] for r in lexical.search(docs, items).orderBy("rank").collect()] == ["a", "b", None]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abAB1 \n\x00é漢-", max_size=60), st.sampled_from([1, 3, 8, 1000]))
def test_terms_in_parts(text, chunk):
    parts = [term.decode() for part in lexical.guarded_parts(text.encode(), chunk) for term in part.split()]
    assert parts == slow_terms(text)


def test_scores_beyond_the_doubles(spark):
    terms = [f"t{k}" for k in range(2000)]
    block = lexical.make_block(spark.createDataFrame([(1, t) for t in terms] + [(2, terms[0])], "i int, t string"))
    counts = {k: 1 for k in range(2000)} | {lexical.DOCUMENTS: 1 << 30, lexical.LENGTH: 1 << 40}
    scorer = lexical.Scorer(block, counts)
    scorer.weights = scorer.weights * 4097  # sums beyond 2**53
    found = Counter(range(2000))
    size = 2000
    norm = 10 + (90 * size * (1 << 30)) // (1 << 40)
    each = int(scorer.weights[0]) * (1_000_000_000 // (1000 + 8 * norm))
    assert scorer.scores(size, found).tolist() == [2000 * each, each]
    assert 2000 * each > lexical.EXACT


def test_query_equals_sql(spark, folder):
    assert differences(spark, database(folder), QUERIES["op11_lexical_search"], SQL["op11_lexical_search"], folder) == []
