"""Token shards: raw ids in key order, with a minimal perfect hash index in each shard.

A shard is one binary image: header, displacement of each bucket, a slot for each
document (fingerprint of its key, offset, length), then the ids one after another.
The hash sends the n keys of a shard to the n slots one to one, so a key is found in
constant time: one displacement, one slot, one comparison of fingerprints. Images
are rows of a Parquet table, because Spark commits those on any shared store,
whichever executors are lost.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import by_size, slices, whole_text
from tagloom.llm.pieces import TEXT_BYTES, library_encoder

#: magic, format version, bytes of an id, documents, buckets, ids, seed
HEADER = struct.Struct("<4sHHQQQQ")
MAGIC, VERSION = b"TLSH", 1
SLOT = struct.Struct("<QQQ")
PER_BUCKET = 4
#: A shard is closed when it holds this many ids or documents.
SHARD_IDS, SHARD_DOCS = 1 << 19, 1 << 13

SHARD_FIELDS = (
    "part int, shard int, first_key bigint, last_key bigint, n_docs bigint, n_ids bigint, before bigint, "
    "keys array<bigint>, repeats array<bigint>, image binary"
)


def key_bytes(key: int | None, repeat: int = 0) -> bytes:
    """What is hashed for a document: its key, and which row of that key it is."""
    return struct.pack("<?qQ", key is None, key or 0, repeat)


class PerfectHash:
    """Hash and displace: x + d // n * y + d % n, modulo n, by the displacement d of the key's bucket."""

    @staticmethod
    def parts(raw: bytes, seed: int, n: int, buckets: int) -> tuple[int, int, int, int]:
        """Bucket, x, y and stored fingerprint of a key."""
        h = xxhash.xxh3_128_intdigest(raw, seed)
        return h % buckets, (h >> 32) % n, 1 + (h >> 64) % max(1, n - 1), h >> 64

    @classmethod
    def build(cls, keys: Sequence[bytes]) -> tuple[int, list[int], list[int]]:
        """Seed, displacement of each bucket, slot of each key (in the keys' order)."""
        n, seed = len(keys), 0
        buckets = max(1, -(-n // PER_BUCKET))
        while True:
            found = cls._place([cls.parts(k, seed, n, buckets) for k in keys], n, buckets)
            if found:
                return seed, *found
            seed += 1

    @staticmethod
    def _place(parts: list[tuple[int, int, int, int]], n: int, buckets: int) -> tuple[list[int], list[int]] | None:
        members: list[list[int]] = [[] for _ in range(buckets)]
        for k, part in enumerate(parts):
            members[part[0]].append(k)
        taken, moves, slots = bytearray(2 * n), [0] * buckets, [0] * n  # twice over, so that shifts need no turn
        full, free = np.frombuffer(taken, np.uint8), 0
        for bucket in sorted(range(buckets), key=lambda b: -len(members[b])):
            here = members[bucket]
            if not here:
                break
            if len(here) == 1:  # any free slot can be reached by a shift alone
                free = taken.index(0, free)
                moves[bucket] = (free - parts[here[0]][1]) % n
                slots[here[0]], full[free], full[free + n] = free, 1, 1
                continue
            for turn in range(min(n, 64)):
                spots = [(parts[k][1] + turn * parts[k][2]) % n for k in here]
                if len(set(spots)) < len(spots):
                    continue
                held = full[spots[0] : spots[0] + n] | full[spots[1] : spots[1] + n]  # by shift
                for spot in spots[2:]:
                    held |= full[spot : spot + n]
                shift = int(held.argmin())
                if not held[shift]:
                    break
            else:
                return None
            moves[bucket] = turn * n + shift
            for k, spot in zip(here, spots, strict=True):
                at = (spot + shift) % n
                slots[k], full[at], full[at + n] = at, 1, 1
        return moves, slots


def build_image(keys: Sequence[bytes], docs: Sequence[bytes], width: int) -> bytes:
    """Shard of documents (ids as little-endian numbers of ``width`` bytes), in the order given."""
    seed, moves, slots = PerfectHash.build(keys)
    n, ids = len(keys), b"".join(docs)
    table = bytearray(SLOT.size * n)
    offset = 0
    for key, doc, slot in zip(keys, docs, slots, strict=True):
        mark = PerfectHash.parts(key, seed, n, len(moves))[3]
        SLOT.pack_into(table, SLOT.size * slot, mark, offset, len(doc) // width)
        offset += len(doc) // width
    head = HEADER.pack(MAGIC, VERSION, width, n, len(moves), offset, seed)
    return b"".join((head, np.array(moves, "<u8").tobytes(), table, ids))


class Shard:
    """Keyed reader of one image."""

    def __init__(self, image: bytes):
        magic, version, self.width, self.n, self.buckets, self.ids, self.seed = HEADER.unpack_from(image)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a token shard of this version")
        self.image = memoryview(image)
        self.slots = HEADER.size + 8 * self.buckets
        self.payload = self.slots + SLOT.size * self.n

    def find(self, key: bytes) -> tuple[int, int] | None:
        """Offset and length in ids, None if the key is not in the shard (up to a 64-bit fingerprint)."""
        if not self.n:
            return None
        bucket, x, y, mark = PerfectHash.parts(key, self.seed, self.n, self.buckets)
        (move,) = struct.unpack_from("<Q", self.image, HEADER.size + 8 * bucket)
        turn, shift = divmod(move, self.n)
        slot = (x + turn * y + shift) % self.n
        stored, offset, length = SLOT.unpack_from(self.image, self.slots + SLOT.size * slot)
        return (offset, length) if stored == mark else None

    def read(self, offset: int, length: int) -> np.ndarray:
        start = self.payload + offset * self.width
        return np.frombuffer(self.image[start : start + length * self.width], f"<u{self.width}").astype("<u4")


def key_bounds(docs: DataFrame, key: str, parts: int) -> list[int]:
    """Keys that cut the table into about even ranges; reads the key column alone."""
    cuts = docs.approxQuantile(key, [k / parts for k in range(1, parts)], 0.25 / parts) if parts > 1 else []
    return sorted({int(x) for x in cuts})


def encoded_ranges(
    docs: DataFrame, tokenizer: str, end_id: int, *, key: str = "doc_id", text: str = "text", parts: int | None = None
) -> DataFrame:
    """(part, key, ids): whole texts encoded, in ranges of the key, sorted within each range.

    The text is read and encoded once; what is shuffled are ids of two bytes
    each where the vocabulary allows. Null keys come first.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = docs.select(F.col(key).cast("bigint").alias("key"), whole_text(text).alias("text"))
    bounds = np.array(key_bounds(columns, "key", parts), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, narrow=True)
        end = end_id.to_bytes(encoder.width, "little")
        for batch in by_size(batches, 1, TEXT_BYTES):
            keys = batch.column(0)
            ids = [x + end for x in encoder.encode(batch.column(1).to_pylist())]
            part = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(), "right")
            made = [pa.array(part.astype(np.int32)), keys, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=["part", "key", "ids"])

    encoded = columns.mapInArrow(run, "part int, key bigint, ids binary")
    return encoded.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "key", "ids")


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    parts: int | None = None,
) -> str:
    """Encode whole texts and write them as shards in ascending order of the key.

    Every document gets ``end_id`` after its ids. Null and empty texts have that
    id alone. Rows of one key stand one after another, ordered by their ids, and
    are told apart by their number; null keys come first. An empty table gives
    an empty shard table.
    """
    width = library_encoder(tokenizer, narrow=True).width
    ranges = encoded_ranges(docs, tokenizer, end_id, key=key, text=text, parts=parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int | None] = []
        repeats: list[int] = []
        ids: list[bytes] = []
        held = shard = before = repeat = 0
        part = None
        last: tuple = ()

        def close() -> pa.RecordBatch:
            image = build_image([key_bytes(*x) for x in zip(keys, repeats, strict=True)], ids, width)
            row = [part, shard, keys[0], keys[-1], len(keys), held, before, list(keys), list(repeats), image]
            return pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, row, strict=True))], schema=SCHEMA)

        for batch in slices(batches):
            for own, key, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keys and (own != part or held >= SHARD_IDS or len(keys) >= SHARD_DOCS):
                    yield close()
                    shard, before = (shard + 1, before + held) if own == part else (0, 0)
                    keys, repeats, ids, held = [], [], [], 0
                repeat = repeat + 1 if last == (own, key) else 0
                last, part = (own, key), own
                keys.append(key)
                repeats.append(repeat)
                ids.append(raw)
                held += len(raw) // width
        if keys:
            yield close()

    ranges.mapInArrow(run, SHARD_FIELDS).write.parquet(path)
    return path


SCHEMA = pa.schema(
    [
        ("part", pa.int32()), ("shard", pa.int32()), ("first_key", pa.int64()), ("last_key", pa.int64()),
        ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("before", pa.int64()), ("keys", pa.list_(pa.int64())),
        ("repeats", pa.list_(pa.int64())), ("image", pa.binary()),
    ]
)

READ_FIELDS = "part int, shard int, key bigint, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint"


def _read(shards: DataFrame, with_ids: bool) -> DataFrame:
    """Rows of the shards' keys, each found through the index. Keys that are not there give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            (row,) = batch.to_pylist()
            shard = Shard(row["image"])
            rows = []
            for key, repeat in zip(row["keys"], row["repeats"], strict=True):
                found = shard.find(key_bytes(key, repeat))
                if found:
                    raw = shard.read(*found).tobytes()
                    rows.append((row["part"], row["shard"], key, row["before"] + found[0], found[1], raw if with_ids else None, zlib.crc32(raw)))
            for start in range(0, len(rows), 1024):
                columns = list(zip(*rows[start : start + 1024], strict=True))
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                names = [x.split()[0] for x in READ_FIELDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return shards.mapInArrow(run, READ_FIELDS)


def _after_others(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Turn starts within a range into starts over all; one total for each range reaches the driver."""
    totals = dict(spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids")).collect())
    order = sorted(totals)
    before = dict(zip(order, accumulate([0, *(totals[p] for p in order)]), strict=False))
    offsets = F.array(*[F.lit(before.get(p, 0)) for p in range(max(order, default=0) + 1)]).cast("array<bigint>")
    return rows.withColumn("start", F.col("start") + F.element_at(offsets, F.col("part") + 1))


def read_shards(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document, looked up in the index of its shard."""
    rows = _after_others(spark, path, _read(spark.read.parquet(path), with_ids))
    return rows.select("key", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def fetch(spark: SparkSession, path: str, wanted: DataFrame, key: str = "key") -> DataFrame:
    """The documents of some keys, through the index; unknown and null keys give no row.

    Keys meet the narrow directory of shards first; a shard is then read once
    for all its wanted keys. Of repeated keys the first row is returned.
    """
    least = -(1 << 63)  # a range may begin with null keys
    shards = spark.read.parquet(path)
    directory = shards.select("part", "shard", F.coalesce("first_key", F.lit(least)).alias("first_key"), "last_key")
    edges = directory.groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
    parts = sorted((r["low"], r["high"], r["part"]) for r in edges.collect() if r["high"] is not None)
    spans = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(p).alias("p")) for a, b, p in parts]
    keys = wanted.select(F.col(key).cast("bigint").alias("k")).filter("k IS NOT NULL").distinct()
    if not spans:
        return _read(shards, True).select("key", "n_tokens", "ids").limit(0)
    held = F.filter(F.array(*spans), lambda s: (s["a"] <= F.col("k")) & (F.col("k") <= s["b"]))
    placed = keys.select("k", F.get(held, 0)["p"].alias("part")).filter("part IS NOT NULL")
    inside = F.col("k").between(F.col("first_key"), F.col("last_key"))
    asked = placed.join(directory, "part").filter(inside).groupBy("part", "shard").agg(F.collect_set("k").alias("keys"))
    lookups = shards.drop("keys", "repeats").join(asked, ["part", "shard"])
    lookups = lookups.withColumn("repeats", F.transform("keys", lambda _: F.lit(0).cast("bigint")))
    return _read(lookups, True).dropDuplicates(["key"]).select("key", "n_tokens", "ids")
