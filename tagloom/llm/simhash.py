"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified bit distance.

Fingerprints are made where the text is read; after that only 64-bit numbers
move. Equal fingerprints are one node. Two fingerprints at most ``distance`` bits
apart agree in at least ``blocks - distance`` of ``blocks`` blocks, so every choice
of that many blocks is a key and each link shares a key with certainty. Within a
key only spanning links are kept: as many as its members, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import slices, text_bytes
from tagloom.llm.graph import components
from tagloom.sources.storage import materialise

BITS = 64
SEED = 42
#: Shingles whose bits are counted at a time: bounds memory for very long texts.
CHUNK = 1 << 14
#: Members of a key that one group holds; larger keys are dealt over pairs of parts.
PART = 1 << 13


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """Majority bits of the shingles' XXH64; zero without words."""
    words = raw.lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    count = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, CHUNK):
        stop = min(start + CHUNK, count)
        runs = zip(*(words[start + k : stop + k] for k in range(size)), strict=True)
        digests = b"".join([xxhash.xxh64_digest(b" ".join(run), SEED) for run in runs])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big", signed=True)


def with_fingerprint(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, name: str = "fingerprint"
) -> DataFrame:
    """(key, fingerprint as signed 64-bit number), one row per input row.

    Words are runs of bytes other than blank and 0x09-0x0D after A-Z became
    lower case. Null and empty texts have fingerprint 0. No shuffle.
    """
    columns = docs.select(F.col(key).alias("k"), text_bytes(text).alias("t"))
    kind = columns.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [fingerprint(raw, shingle) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=["k", "f"])

    made = columns.mapInArrow(run, f"k {kind}, f bigint")
    return made.select(F.col("k").alias(key), F.col("f").alias(name))


def block_count(fingerprints: int, distance: int, share: int = 64) -> int:
    """Blocks to cut into: the fewest that leave about ``share`` random members to a key."""
    for blocks in range(distance + 1, 4 * distance + 8):
        if fingerprints >> (BITS * (blocks - distance) // blocks) <= share:
            break
    return blocks


def block_keys(name: str, blocks: int, distance: int) -> Column:
    """Array of 64-bit keys: the fingerprint under each mask, mixed with the mask's number."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [((1 << edges[k + 1]) - (1 << edges[k])) for k in range(blocks)]
    keys = []
    for number, chosen in enumerate(combinations(parts, blocks - distance)):
        mask = sum(chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("block"), F.col(name).bitwiseAND(F.lit(signed)).alias("bits")))
    assert len(keys) == comb(blocks, blocks - distance)
    return F.array(*keys)


def spanning_links(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (root, member) that connect what chains of close members connect.

    Breadth-first from each unvisited member: every member is compared with
    those not yet reached, so a dense group takes about one pass, and the
    output is shorter than the input.
    """
    left, links = members.view(np.uint64), []  # bitwise_count takes the absolute value of signed numbers
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            close = np.bitwise_count(left ^ queue.pop()) <= distance
            if close.any():
                reached = left[close]
                left = left[~close]
                links += [(int(root.view(np.int64)), x) for x in reached.view(np.int64).tolist()]
                queue += list(reached)
    return links


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Members of each key, from rows that arrive in the order of keys."""
    last, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        *keys, member = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = np.zeros(len(member), bool)
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        cuts = [0, *np.flatnonzero(new), len(member)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            here = tuple(key[start] for key in keys)
            if here != last and parts:
                yield np.concatenate(parts)
                parts = []
            last = here
            parts.append(member[start:stop])
    if parts:
        yield np.concatenate(parts)


def links(nodes: DataFrame, name: str = "fingerprint", distance: int = 4, blocks: int | None = None) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints at most ``distance`` bits apart.

    Keys with more than ``PART`` members are dealt over pairs of parts, so no
    task holds a large group and still every two members meet.
    """
    distinct = nodes.select(name).filter(F.col(name).isNotNull()).distinct()
    blocks = blocks or block_count(distinct.count(), distance)
    keyed = distinct.select(F.explode(block_keys(name, blocks, distance)).alias("key"), F.col(name).alias("f"))
    keyed = keyed.select("key.block", "key.bits", "f")
    counted = keyed.groupBy("block", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / PART)
    own = F.pmod(F.xxhash64("f"), F.col("parts"))
    met = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.struct(F.least(own, k).alias("one"), F.greatest(own, k).alias("two")),
    )
    dealt = (
        keyed.join(counted.withColumn("parts", parts), ["block", "bits"])
        .select("block", "bits", F.explode(met).alias("tile"), "f")
        .select("block", "bits", "tile.one", "tile.two", "f")
    )
    keys = ["block", "bits", "one", "two"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "f")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[int, int]] = []
        for members in _runs(batches):
            if len(members) == 2:
                a, b = members.tolist()
                if ((a ^ b) & ((1 << BITS) - 1)).bit_count() <= distance:
                    made.append((a, b))
            else:
                made += spanning_links(members, distance)
            if len(made) > 10_000:
                yield _pairs(made)
                made = []
        yield _pairs(made)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _pairs(made: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = ([x[k] for x in made] for k in range(2))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = 4, distance: int = 4
) -> DataFrame:
    """(key, fingerprint, component_id): component_id is the smallest key reachable by links.

    One row per input row, repeated keys included. Null texts count as empty;
    an empty text has fingerprint 0, linked like any other. A null key keeps its
    row and never names a component unless all its keys are null. An empty
    table gives an empty result.
    """
    rows = materialise(with_fingerprint(docs, key, text, shingle), "fingerprints")
    return rows.join(_classes(rows, key, distance), "fingerprint").select(key, "fingerprint", "component_id")


def _classes(rows: DataFrame, key: str, distance: int) -> DataFrame:
    """(fingerprint, component_id) of a written table: the smallest key of all rows that links reach."""
    named = rows.groupBy("fingerprint").agg(F.min(key).alias("least"))
    found = materialise(components(links(rows, distance=distance)), "components")
    group = F.coalesce("component", "fingerprint")
    nodes = named.join(found, named["fingerprint"] == found["node"], "left").select("fingerprint", "least", group.alias("g"))
    # Written, so that the join is a plain one, whose large groups Spark can split.
    least = materialise(nodes.groupBy("g").agg(F.min("least").alias("component_id")), "least")
    return nodes.join(least, "g").select("fingerprint", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component, all columns: that with the smallest key, nulls last, of equal keys the first.

    Rows are told apart by numbers in a written copy, not by key: rows that
    share a key stay if their texts are in different components, and copies
    without a key are copies.
    """
    number = "row"
    while number in docs.columns:
        number += "_"
    numbered = materialise(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    rank = F.struct(F.col(key).isNull().alias("missing"), F.col(key).alias("key"), F.col(number).alias("row"))
    ranked = numbered.select(rank.alias("rank"), F.col(text).alias("t"))
    rows = materialise(with_fingerprint(ranked, "rank", "t", shingle), "fingerprints")
    kept = _classes(rows, "rank", distance).select(F.col("component_id.row").alias(number)).distinct()
    return numbered.join(kept, number, "left_semi").select(*docs.columns)
