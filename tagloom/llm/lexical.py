"""Ranked lexical search: one automaton of all query terms reads every document.

The terms of the items stand in an Aho-Corasick automaton, each between two blanks.
In a text every byte outside a term becomes a blank, so an occurrence with both
guards is a whole term and its count is the term frequency: no table of document
terms is made, neither for the collection's counts nor for the scores. Outputs of
the automaton are numbers of terms, and a term's postings are the items that hold it.

The texts are read twice: once for the number of documents, their lengths and the
document frequencies of the items' terms, once for the scores. Each task keeps the
best documents of each item; those meet in two rounds, so no task sees them all.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import slices, text_bytes, whole_text

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A term: letters and digits of ASCII and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GUARD = 32
#: What a byte of a text becomes: A-Z lower case, other ASCII but letters and digits a blank.
PLAIN = bytes(
    ord(LOWER[b - 65]) if 65 <= b <= 90 else b if b > 127 or chr(b) in LOWER or 48 <= b <= 57 else GUARD for b in range(256)
)
#: Bytes of terms and postings that one automaton is built from, about; more items make more automata.
BLOCK_BYTES = 4 << 20
#: What a posting counts besides the bytes of its term.
POSTING_BYTES = 24
#: Bytes of a text that the automaton reads at a time, to the next blank: bounds memory for very long texts.
CHUNK = 1 << 20
#: Groups in which the tasks' best documents of an item meet first.
ROUNDS = 64
#: Integers below this are exact as doubles.
EXACT = 1 << 53
#: Rows of the collection's counts that are not terms.
DOCUMENTS, LENGTH = -1, -2


@dataclass(frozen=True)
class Block:
    """Terms of a bounded set of items; the items of term t are ``postings[starts[t]:starts[t + 1]]``."""

    items: pa.Array
    terms: list[str]
    starts: np.ndarray
    postings: np.ndarray

    def automaton(self) -> ahocorasick.Automaton:
        """Bytes are read as Latin-1 letters, so that the automaton works on UTF-8."""
        machine = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            machine.add_word(f" {term.encode().decode('latin-1')} ", number)
        machine.make_automaton()
        return machine


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(i, t): the distinct terms of each item; rows that share an item's id are one item."""
    plain = F.translate(whole_text(text), UPPER, LOWER)
    found = F.regexp_extract_all(plain, F.lit(f"({TERM})"))
    return items.select(F.col(item).alias("i"), F.explode(found).alias("t")).distinct()


def make_block(pairs: DataFrame) -> Block:
    """The block of (i, t) rows, which must be few; terms and items are sorted."""
    rows = pairs.orderBy("t", "i").toArrow()
    items, terms = rows["i"].combine_chunks(), rows["t"].to_pylist()
    known = items.dictionary_encode(null_encoding="encode")
    starts = [k for k, term in enumerate(terms) if not k or term != terms[k - 1]]
    return Block(
        known.dictionary, [terms[k] for k in starts],
        np.array([*starts, len(terms)], np.int64), known.indices.to_numpy().astype(np.int64),
    )


def guarded_parts(raw: bytes, chunk: int = CHUNK) -> Iterator[bytes]:
    """The text with terms in lower case and blanks around each; cut between terms only."""
    plain = raw.translate(PLAIN)
    start = 0
    while start < len(plain):
        stop = plain.find(b" ", start + chunk)
        stop = len(plain) if stop < 0 else stop
        yield b" " + plain[start:stop] + b" "
        start = stop


def tally(machine: ahocorasick.Automaton, raw: bytes, chunk: int = CHUNK) -> tuple[int, Counter]:
    """(terms of the text with repeats, {number of a query term: occurrences})."""
    size, found = 0, Counter()
    for part in guarded_parts(raw, chunk):
        gap = np.frombuffer(part, np.uint8) == GUARD
        size += int(np.count_nonzero(gap[:-1] & ~gap[1:]))
        found.update(map(itemgetter(1), machine.iter(part.decode("latin-1"))))
    return size, found


def collection_counts(texts: DataFrame, block: Block) -> dict[int, int]:
    """{term: documents that hold it}, and the documents with terms and their length under keys of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = block.automaton()
        held = np.zeros(len(block.terms) + 2, np.int64)
        for batch in slices(batches):
            for raw in batch.column(1).to_pylist():
                size, found = tally(machine, raw)
                if size:
                    held[DOCUMENTS] += 1
                    held[LENGTH] += size
                    held[list(found)] += 1
        numbers = np.arange(len(held))
        numbers[DOCUMENTS], numbers[LENGTH] = DOCUMENTS, LENGTH
        seen = held > 0
        yield pa.RecordBatch.from_arrays([pa.array(numbers[seen], pa.int64()), pa.array(held[seen], pa.int64())], names=["t", "n"])

    counted = texts.mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    return {r["t"]: r["n"] for r in counted.collect()}


def weight(documents: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))


class Scorer:
    """Scores of all items of a block for one document, from its term counts."""

    def __init__(self, block: Block, counts: dict[int, int]):
        self.block, self.documents, self.length = block, counts[DOCUMENTS], counts[LENGTH]
        self.weights = np.array([weight(self.documents, counts.get(t, 0)) for t in range(len(block.terms))], np.int64)

    def scores(self, size: int, found: Counter) -> np.ndarray:
        terms = np.fromiter(found, np.int64, len(found))
        times = np.fromiter(found.values(), np.int64, len(found))
        norm = 100 - 90 + (90 * size * self.documents) // self.length
        values = self.weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * norm))
        first = self.block.starts[terms]
        many = self.block.starts[terms + 1] - first
        place = np.arange(many.sum()) + np.repeat(first - np.cumsum(many) + many, many)
        items, parts = self.block.postings[place], np.repeat(values, many)
        if values.sum() < EXACT:  # no item sums more than all terms
            return self._sum(items, parts)
        return self._sum(items, parts & 0xFFFFF) + (self._sum(items, parts >> 20) << 20)

    def _sum(self, items: np.ndarray, parts: np.ndarray) -> np.ndarray:
        return np.bincount(items, weights=parts, minlength=len(self.block.items)).astype(np.int64)


class Best:
    """The ``top`` best documents of each item that a task has seen."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.rows: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)

    def offer(self, key, scores: np.ndarray) -> None:
        for item in np.flatnonzero(scores >= self.least).tolist():
            rows = self.rows[item]
            insort(rows, (-int(scores[item]), key is None, 0 if key is None else key))
            if len(rows) > self.top:
                rows.pop()
            if len(rows) == self.top:
                self.least[item] = -rows[-1][0]

    def records(self) -> Iterator[tuple]:
        """(item, score, key)"""
        for item, rows in enumerate(self.rows):
            for score, missing, key in rows:
                yield item, -score, None if missing else key


def ranked(rows: DataFrame, top: int, *by: str | Column) -> DataFrame:
    """The ``top`` rows of each group with their rank ``r``: highest score first, then smallest key, nulls last."""
    order = Window.partitionBy(*by).orderBy(F.desc("s"), F.asc_nulls_last("k"))
    return rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= top)


def search_block(texts: DataFrame, block: Block, top: int, kinds: tuple[str, str]) -> DataFrame:
    """(i, k, s): the best documents of every task for every item of the block."""
    counts = collection_counts(texts, block)
    if DOCUMENTS not in counts:
        return texts.sparkSession.createDataFrame([], f"i {kinds[0]}, k {kinds[1]}, s bigint")
    scorer = Scorer(block, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, best, kind = block.automaton(), Best(len(block.items), top), None
        for batch in slices(batches):
            kind = batch.schema.field(0).type
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                size, found = tally(machine, raw)
                if found:
                    best.offer(key, scorer.scores(size, found))
        if kind is not None:
            items, scores, keys = ([*column] for column in zip(*best.records(), strict=True)) if any(best.rows) else ([], [], [])
            named = block.items.take(pa.array(items, pa.int64()))
            yield pa.RecordBatch.from_arrays([named, pa.array(keys, kind), pa.array(scores, pa.int64())], names=["i", "k", "s"])

    return texts.mapInArrow(run, f"i {kinds[0]}, k {kinds[1]}, s bigint")


def search(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text",
    item: str = "item_id", query: str = "text", top: int = 10, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item, rank, key, score): the ``top`` documents of each item with a score above 0, all if there are fewer.

    A term's weight is floor(1000 ln((2N + 2) / (2df + 1))), its part of a score
    weight * ((10^9 tf) div (1000 tf + 8m)) with m = 10 + (90 n N) div L: N documents
    with terms, L their terms, n this document's. Every item's terms count once.
    Equal scores go by the smallest key, null keys last; rows that share a key are
    documents of their own. Rows that share an item's id are one item with the terms
    of all; a null id is an id. Null texts have no terms, and an item or document
    without terms is in no result; without documents or items the result is empty.
    Key and item columns need different names.

    Items whose terms exceed ``block_bytes`` are dealt by hash over several automata,
    each with its own scans; an item is never cut, so one item's terms must fit a
    task. Counts of a block's terms reach the driver, nothing of the documents.
    """
    if key == item:
        raise ValueError(f"Documents and items both go by {key!r}")
    pairs = item_terms(items, item, query)
    total = pairs.agg(F.sum(F.octet_length("t") + POSTING_BYTES)).first()[0]
    texts = docs.select(F.col(key).alias("k"), text_bytes(text).alias("t"))
    kinds = (pairs.schema["i"].dataType.simpleString(), texts.schema["k"].dataType.simpleString())
    blocks = -(-(total or 0) // block_bytes)
    found = texts.sparkSession.createDataFrame([], f"i {kinds[0]}, k {kinds[1]}, s bigint")
    if blocks:
        dealt = F.pmod(F.xxhash64("i"), F.lit(blocks))
        made = [make_block(pairs.filter(dealt == b) if blocks > 1 else pairs) for b in range(blocks)]
        found = reduce(DataFrame.unionByName, [search_block(texts, b, top, kinds) for b in made if b.terms], found)
    near = ranked(found.withColumn("p", F.pmod(F.spark_partition_id(), F.lit(ROUNDS))), top, "i", "p")
    best = ranked(near.select("i", "k", "s"), top, "i")
    return best.select(F.col("i").alias(item), F.col("r").alias("rank"), F.col("k").alias(key), F.col("s").alias("score"))
