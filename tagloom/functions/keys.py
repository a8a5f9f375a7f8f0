"""Row keys and hash-based placement, all pure expressions (no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and bucket counts that decide keys and placement.
KEY_SEPARATOR = "||"
SEED_SEPARATOR = "::"
XXHASH_BUCKETS = 10_000_000
MD5_BUCKETS = 10_000


def row_key(*parts: Column) -> Column:
    """SHA-256 over the parts in order; a null part counts as ``''``."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *texts), 256)


def unit_hash(value: Column, *, seed: int = 42, method: str = "xxhash64") -> Column:
    """Reproducible number in [0, 1) for a value: same value and seed, same number.

    ``md5`` gives the same number in any SQL engine; ``xxhash64`` is cheaper.
    """
    salted = F.concat_ws(SEED_SEPARATOR, F.lit(str(seed)), value.cast("string"))
    if method == "xxhash64":
        bucket = F.pmod(F.xxhash64(salted), F.lit(XXHASH_BUCKETS))
        return bucket.cast("double") / F.lit(float(XXHASH_BUCKETS))
    if method == "md5":
        head = F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("long")
        return (head % MD5_BUCKETS).cast("double") / F.lit(float(MD5_BUCKETS))
    raise ValueError(f"Unknown hash method: {method}")


def order_hash(value: Column, *, seed: int = 42, method: str = "xxhash64") -> Column:
    """Hex digits of a seeded hash, by which rows have an order that no layout changes."""
    salted = F.concat_ws(SEED_SEPARATOR, F.lit(str(seed)), value.cast("string"))
    if method == "xxhash64":
        return F.lpad(F.hex(F.xxhash64(salted)), 16, "0")
    if method == "md5":
        return F.md5(salted)
    raise ValueError(f"Unknown hash method: {method}")


def split_name(
    entity: Column,
    *,
    train: float = 0.8,
    val: float = 0.1,
    test: float = 0.1,
    seed: int = 42,
    method: str = "xxhash64",
) -> Column:
    """``train``/``val``/``test`` by entity, so an entity never straddles splits.

    A null entity goes to ``train``.
    """
    if abs(train + val + test - 1.0) > 1e-6:
        raise ValueError(f"Split fractions must sum to 1, got {train + val + test}")
    position = unit_hash(entity, seed=seed, method=method)
    return (
        F.when(entity.isNull() | (position < train), "train")
        .when(position < train + val, "val")
        .otherwise("test")
    )
