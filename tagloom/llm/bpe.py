"""Byte-level BPE by rank: encode and decode whole texts.

Merges follow a segment tree over the byte positions of a piece. A leaf holds the
rank of the pair that starts there, joined with its position, so the root is the
leftmost pair of the lowest rank. A merge kills one leaf and renews two: three point
updates of logarithmic cost. Short pieces run as many trees at once, as rows of one
numpy array; long ones as one tree of Python numbers, with the same steps.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import by_size, slices, whole_text
from tagloom.llm.pieces import MEMO_BYTES, TEXT_BYTES, PieceEncoder

#: Pieces of more bytes than this get a tree of their own.
SHORT = 64
#: Trees that advance together.
TOGETHER = 4096


class Ranks:
    """Vocabulary of a rank file: one base64 token and its rank a line."""

    def __init__(self, lines: Sequence[bytes]):
        tokens = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}
        self.tokens = [b""] * (max(tokens.values()) + 1)
        for token, rank in tokens.items():
            self.tokens[rank] = token
        self.single = np.array([tokens[bytes([b])] for b in range(256)], np.int64)
        self.pairs: dict[tuple[int, int], int] = {}
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = rank
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array(list(self.pairs.values()), np.int64)[order]
        self.whole = {token: rank.to_bytes(4, "little") for token, rank in tokens.items()}
        self.none = len(self.tokens)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``none`` where it has none or an end is missing (-1)."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.ranks[at], self.none)

    def encode(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit numbers. A piece that is a token is that token."""
        made: list[bytes | None] = [self.whole.get(p) for p in pieces]
        by_size: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if made[k] is None:
                if not piece:
                    made[k] = b""
                elif len(piece) > SHORT:
                    made[k] = self.encode_long(piece)
                else:
                    by_size.setdefault(1 << (len(piece) - 1).bit_length(), []).append(k)
        for leaves, members in by_size.items():
            for start in range(0, len(members), TOGETHER):
                some = members[start : start + TOGETHER]
                for k, ids in zip(some, self._encode_together([pieces[k] for k in some], leaves), strict=True):
                    made[k] = ids
        return made

    def _encode_together(self, pieces: Sequence[bytes], leaves: int) -> list[bytes]:
        rows, levels = len(pieces), leaves.bit_length() - 1
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(rows, leaves)
        sizes = np.array([len(p) for p in pieces])
        places = np.arange(leaves)
        ids = np.where(places < sizes[:, None], self.single[raw], -1)
        after = np.minimum(np.broadcast_to(places + 1, (rows, leaves)), sizes[:, None])  # its size: no successor
        before = np.broadcast_to(places - 1, (rows, leaves)).copy()
        after = np.hstack([after, np.full((rows, 1), leaves)])
        ids, before = np.hstack([ids, np.full((rows, 1), -1)]), np.hstack([before, np.full((rows, 1), -1)])
        never = self.none * leaves
        right = np.take_along_axis(ids, after[:, :leaves], 1)
        ranks = self.pair_ranks(ids[:, :leaves], right)
        tree = np.full((rows, 2 * leaves), never, np.int64)
        tree[:, leaves:] = np.where(ranks < self.none, ranks * leaves + places, never)
        for level in range(levels - 1, -1, -1):
            lo = 1 << level
            tree[:, lo : 2 * lo] = np.minimum(tree[:, 2 * lo : 4 * lo : 2], tree[:, 2 * lo + 1 : 4 * lo : 2])
        live = np.arange(rows)
        while len(live := live[tree[live, 1] < never]):
            rank, here = np.divmod(tree[live, 1], leaves)
            gone = after[live, here]
            beyond, ahead = after[live, gone], before[live, here]
            beyond = np.minimum(beyond, leaves)
            ids[live, here], ids[live, gone] = rank, -1
            after[live, here] = beyond
            before[live, beyond] = here
            # the spare last column stands for both missing ends; it keeps id -1
            lead = np.where(ahead < 0, leaves, ahead)
            renewed = self.pair_ranks(
                np.concatenate([rank, ids[live, lead]]), np.concatenate([ids[live, beyond], rank])
            ).reshape(2, -1)
            values = np.where(renewed < self.none, renewed * leaves + np.stack([here, lead]), never)
            tree[live, leaves + gone] = never
            tree[live, leaves + here] = values[0]
            known = ahead >= 0
            tree[live[known], leaves + ahead[known]] = values[1][known]
            row = np.concatenate([live, live, live])
            node = leaves + np.concatenate([gone, here, np.where(known, ahead, here)])
            for _ in range(levels):
                tree[row, node >> 1] = np.minimum(tree[row, node], tree[row, node ^ 1])
                node >>= 1
        kept = ids[:, :leaves]
        counts = (kept >= 0).sum(axis=1)
        flat = kept[kept >= 0].astype("<u4").tobytes()
        ends = np.cumsum(counts) * 4
        return [flat[stop - 4 * n : stop] for stop, n in zip(ends.tolist(), counts.tolist(), strict=True)]

    def encode_long(self, piece: bytes) -> bytes:
        """The same for one piece of any length."""
        size = len(piece)
        leaves = 1 << (size - 1).bit_length() if size > 1 else 1
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        pairs, never = self.pairs, (self.none, 0)
        tree = [never] * (2 * leaves)
        for k in range(size - 1):
            rank = pairs.get((ids[k], ids[k + 1]))
            if rank is not None:
                tree[leaves + k] = (rank, k)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def renew(place: int) -> None:
            rank = pairs.get((ids[place], ids[after[place]])) if after[place] < size and ids[place] >= 0 else None
            node = leaves + place
            tree[node] = never if rank is None else (rank, place)
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    break
                tree[node] = least

        while leaves > 1 and tree[1] != never:
            rank, here = tree[1]
            gone = after[here]
            beyond = after[gone]
            ids[here], ids[gone] = rank, -1
            after[here] = beyond
            if beyond < size:
                before[beyond] = here
            renew(gone)
            renew(here)
            if before[here] >= 0:
                renew(before[here])
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def ranks_of(path: str) -> Ranks:
    with open(path, "rb") as lines:
        return Ranks([line for line in lines.read().split(b"\n") if line])


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> PieceEncoder:
    ranks, matches = ranks_of(path), regex.compile(pattern)

    def whole(texts: Sequence[str]) -> list[bytes]:
        cut = [[part.encode() for part in matches.findall(text)] for text in texts]
        parts = list({part for x in cut for part in x})
        ids = dict(zip(parts, ranks.encode(parts), strict=True))
        return [b"".join([ids[part] for part in x]) for x in cut]

    def letters(words: Sequence[str], led: bool) -> list[bytes]:
        return ranks.encode([(" " + word if led else word).encode() for word in words])

    return PieceEncoder(letters, whole, memo_bytes=MEMO_BYTES // 2)


def encode(docs: DataFrame, path: str, pattern: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of each whole text as little-endian 32-bit numbers, one row per input row.

    Every match of ``pattern`` is encoded by itself; no special tokens. Null and
    empty texts have no ids. ``path`` is a rank file that every executor can
    open, as an installed vocabulary is. No shuffle; memory follows a few rows
    and a bounded memo of pieces.
    """
    columns = docs.select(F.col(key).alias("k"), whole_text(text).alias("t"))
    kind = columns.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        for batch in by_size(batches, 1, TEXT_BYTES // 2):
            ids = pa.array(encoder.encode(batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["k", "ids"])

    return columns.mapInArrow(run, f"k {kind}, ids binary").withColumnRenamed("k", key)


def decode(encoded: DataFrame, path: str, *, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The table with the bytes that the ids stand for in a column ``name``; null ids give null."""
    schema = encoded.withColumn(name, F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        for batch in slices(batches):
            raw = [None if x is None else ranks.decode(x) for x in batch.column(ids).to_pylist()]
            kept = {n: batch.column(n) for n in batch.schema.names if n != name}
            yield pa.RecordBatch.from_pydict({n: kept.get(n, None) if n in kept else pa.array(raw, pa.binary()) for n in schema.names})

    return encoded.mapInArrow(run, schema)
