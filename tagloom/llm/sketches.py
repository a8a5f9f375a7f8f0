"""Threshold-scaled document sketches: every shingle hash below a fixed fraction is kept.

Whether a hash is kept depends on the hash alone, so sketches of parts can be merged
and those of very unequal documents compared: the share of the smaller sketch that
the larger one holds estimates containment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import slices, text_bytes, whole_text

SHINGLE = 5
#: Kept share of all hashes.
FRACTION = 1 / 8
#: Bits of a hash that are written down, as hex digits.
BITS = 48
STEP = np.uint64(0x9E3779B97F4A7C15)


def sketch(raw: bytes, shingle: int = SHINGLE, fraction: float = FRACTION) -> np.ndarray:
    """Ascending kept hashes of a text; its smallest hash if none is below the fraction.

    Shingles are runs of ``shingle`` words after A-Z became lower case; fewer
    words are one shingle. A text without words has an empty sketch.
    """
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)
    size = min(shingle, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashes[k : len(words) - size + 1 + k]) * STEP
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed * STEP) >> np.uint64(64 - BITS)
    kept = np.unique(mixed[mixed < np.uint64(fraction * (1 << BITS))])
    return kept if len(kept) else mixed.min(keepdims=True)


def merge(sketches: list[np.ndarray], fraction: float = FRACTION) -> np.ndarray:
    """Sketch of what the sketched texts hold together."""
    together = np.unique(np.concatenate([*sketches, np.zeros(0, np.uint64)]))
    kept = together[together < np.uint64(fraction * (1 << BITS))]
    return kept if len(kept) else together[:1]


def written(kept: np.ndarray) -> str:
    """Fingerprint: the kept hashes as hex digits, ascending."""
    return kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes().hex()


def parsed(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, BITS // 8)
    return np.pad(raw, ((0, 0), (8 - BITS // 8, 0))).copy().view(">u8").ravel().astype(np.uint64)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smaller sketch in the larger: 1 for two empty ones, 0 if one is empty."""
    least = min(len(a), len(b))
    if not least:
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least


def with_sketch(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, fraction: float = FRACTION
) -> DataFrame:
    """(key, fingerprint), one row per input row; equal texts have equal fingerprints. No shuffle.

    Null and empty texts, and texts of white space, have the empty fingerprint.
    """
    columns = docs.select(F.col(key).alias("k"), text_bytes(text).alias("t"))
    kind = columns.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [written(sketch(raw, shingle, fraction)) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made)], names=["k", "f"])

    return columns.mapInArrow(run, f"k {kind}, f string").select(F.col("k").alias(key), F.col("f").alias("fingerprint"))


def beside_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """(part, guest, k, key, text): ranges of the key in order, each followed by the head of the next.

    The key must be a number. Rows sort by key, then text; null keys come first.
    The first rows of a range are also dealt, as guests, to the end of the range
    before it (those of the first to the last), so each row's successor stands
    next to it and no task sees more than its range. One bound and one smallest
    key for each range reach the driver.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(-(1 << 63)).cast("bigint")
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), least).alias("k"), F.col(key).alias("key"), whole_text(text).alias("text")
    )
    cuts = rows.filter("key IS NOT NULL").approxQuantile("k", [i / parts for i in range(1, parts)], 0.25 / parts)
    bounds = sorted({int(x) for x in cuts or []})
    limits = F.array(*[F.lit(x) for x in bounds]).cast("array<bigint>")
    part = F.size(F.filter(limits, lambda b: b <= F.col("k"))) if bounds else F.lit(0)
    heads = dict(rows.select(part.alias("part"), "k").groupBy("part").agg(F.min("k")).collect())
    order = sorted(heads)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    size = len(bounds) + 1
    head = F.array(*[F.lit(heads.get(p)) for p in range(size)]).cast("array<bigint>")
    ahead = F.array(*[F.lit(before.get(p, 0)) for p in range(size)]).cast("array<int>")
    home = F.struct(F.col("part"), F.lit(False).alias("guest"))
    visit = F.struct(F.element_at(ahead, F.col("part") + 1).alias("part"), F.lit(True).alias("guest"))
    places = F.when(F.col("k") == F.element_at(head, F.col("part") + 1), F.array(home, visit)).otherwise(F.array(home))
    dealt = rows.withColumn("part", part).withColumn("place", F.explode(places))
    dealt = dealt.select("place.part", "place.guest", "k", "key", "text")
    return dealt.repartitionById(size, F.col("part")).sortWithinPartitions("part", "guest", "k", "text")


def compare_edited(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, fraction: float = FRACTION
) -> DataFrame:
    """Fingerprint of each text, of its edited text, and how near they and the next text's are.

    The edited text has its last n // 2 code points replaced by as many (or all)
    of the next document's first ones; next means ascending key, then text, and
    the first after the last. A single row is its own successor. An empty table
    gives an empty result. Likeness is containment (see above).
    """
    ordered = beside_next(docs, key=key, text=text)
    kind = ordered.schema["key"].dataType.simpleString()
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = done = None
        for batch in slices(batches):
            rows = []
            key_type = batch.schema.field("key").type
            for _, guest, _, name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if done:
                    break
                own = sketch(text.encode(), shingle, fraction)
                if held is not None:
                    rows.append(compared(*held, text, own))
                held, done = (name, text, own), guest
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [key_type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(made, names=names)

    def compared(name, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
        gone = len(text) // 2
        edited = (text[: len(text) - gone] + following[:gone]).encode()
        changed = sketch(edited, shingle, fraction)
        return (
            name, len(text), hashlib.sha256(edited).hexdigest(), written(own), written(changed),
            containment(own, changed), containment(own, other),
        )

    fields = (
        f"key {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return ordered.mapInArrow(run, fields).withColumnRenamed("key", key)
