"""Pack documents into fixed windows with bounded memory.

Every task keeps a fixed number of open windows. A piece goes to the open window
that it fills best; when none has room the fullest one takes what it can, is
emitted, and the rest of the piece goes on. What is open at the end of a task is
merged with that of other tasks, a bounded number at a time, level by level.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import by_size, whole_text
from tagloom.llm.pieces import TEXT_BYTES, library_encoder
from tagloom.sources.storage import materialise

#: Open windows of a task, and tasks (or groups of them) merged at a time.
OPEN, MERGED = 32, 16
ID = 4


class Packer:
    """Windows of ``size`` ids. Emits (sequence, pieces); a piece is (key, start, doc_tokens, ids)."""

    def __init__(self, size: int, emit: Callable[[list[tuple]], None], windows: int = OPEN):
        self.size, self.emit, self.windows = size, emit, windows
        self.open: dict[int, list[tuple]] = {}
        self.room: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.next = 0

    def _put(self, at: int, piece: tuple) -> None:
        free, window = self.room.pop(at)
        self.open[window].append(piece)
        free -= len(piece[3]) // ID
        if free:
            insort(self.room, (free, window))
        else:
            self.emit(self.open.pop(window))

    def add(self, key, start: int, doc_tokens: int, ids: bytes) -> None:
        """Place the ids of a document from ``start`` on."""
        whole = self.size * ID
        while len(ids) >= whole:
            self.emit([(key, start, doc_tokens, ids[:whole])])
            start, ids = start + self.size, ids[whole:]
        while ids:
            at = bisect_left(self.room, (len(ids) // ID, -1))
            if at < len(self.room):
                self._put(at, (key, start, doc_tokens, ids))
                return
            if len(self.room) < self.windows:
                self.open[self.next] = []
                insort(self.room, (self.size, self.next))
                self.next += 1
                continue
            free = self.room[0][0]  # the fullest takes a part, which closes it
            self._put(0, (key, start, doc_tokens, ids[: free * ID]))
            start, ids = start + free, ids[free * ID :]

    def left(self) -> list[tuple]:
        """Pieces of the open windows, fullest first."""
        return [piece for _, window in self.room for piece in self.open[window]]


def close_rest(pieces: Sequence[tuple], size: int) -> Iterator[list[tuple]]:
    """Windows for the last pieces: full ones, then one for each power of two in what remains."""
    total = sum(len(p[3]) // ID for p in pieces)
    sizes = [size] * (total // size)
    rest = total % size
    sizes += [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    queue = list(reversed(pieces))
    for room in sizes:
        window = []
        while room:
            key, start, doc_tokens, ids = queue.pop()
            taken = min(room, len(ids) // ID)
            window.append((key, start, doc_tokens, ids[: taken * ID]))
            room -= taken
            if taken * ID < len(ids):
                queue.append((key, start + taken, doc_tokens, ids[taken * ID :]))
        yield window


def _fields(kind: str) -> str:
    return (
        f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, ids binary, part bigint"
    )


class _Rows:
    """Collects finished sequences as rows; numbers them by level, part and order."""

    def __init__(self, level: int, part: int, key_type: pa.DataType, with_ids: bool):
        self.next = level << 58 | part << 32
        self.part, self.with_ids, self.key_type = part, with_ids, key_type
        self.rows: list[tuple] = []

    def finish(self, window: list[tuple]) -> None:
        offset = 0
        for key, start, doc_tokens, ids in window:
            length = len(ids) // ID
            kept = ids if self.with_ids else None
            self.rows.append((key, start, length, zlib.crc32(ids), doc_tokens, self.next, offset, kept, None))
            offset += length
        self.next += 1

    def keep(self, pieces: list[tuple]) -> None:
        for key, start, doc_tokens, ids in pieces:
            self.rows.append((key, start, len(ids) // ID, zlib.crc32(ids), doc_tokens, None, None, ids, self.part))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * 9
        self.rows = []
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"]
        kinds = [self.key_type, *[pa.int64()] * 6, pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    size: int = 2048,
    windows: int = OPEN,
    with_ids: bool = False,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]): one row per piece.

    A document is its text's ids and ``end_id``; a null or empty text is that id
    alone. Every id lies in exactly one piece. All sequences are full but the
    last few, whose lengths are different powers of two: nothing needs padding.
    Rows with repeated or null keys are documents like any other. Sequence
    numbers are unique, not consecutive. An empty table gives no pieces.

    Texts are encoded where they are read, without a shuffle; only open windows
    move on, at most ``windows`` from a task.
    """
    columns = docs.select(F.col(key).alias("k"), whole_text(text).alias("t"))
    kind = columns.schema["k"].dataType.simpleString()
    end = end_id.to_bytes(ID, "little")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows = library_encoder(tokenizer), None
        for batch in by_size(batches, 1, TEXT_BYTES):
            if rows is None:
                rows = _Rows(0, TaskContext.get().partitionId(), batch.schema.field(0).type, with_ids)
                packer = Packer(size, rows.finish, windows)
            encoded = encoder.encode(batch.column(1).to_pylist())
            for name, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                packer.add(name, 0, len(ids) // ID + 1, ids + end)
            yield rows.batch()
        if rows is not None:
            rows.keep(packer.left())
            yield rows.batch()

    def merge(level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            group = table.column("group")[0].as_py()
            rows = _Rows(level, group, table.schema.field("key").type, with_ids)
            packer = Packer(size, rows.finish, windows)
            ordered = table.sort_by([("part", "ascending"), ("ids_crc32", "ascending"), ("start", "ascending")])
            for row in ordered.to_pylist():
                packer.add(row["key"], row["start"], row["doc_tokens"], row["ids"])
            if last:
                for window in close_rest(packer.left(), size):
                    rows.finish(window)
            else:
                rows.keep(packer.left())
            return pa.Table.from_batches([rows.batch()])

        return run

    fields = _fields(kind)
    packed = materialise(columns.mapInArrow(first, fields), "packed")
    done, level = packed.filter("part IS NULL"), 0
    while True:
        rest = packed.filter("part IS NOT NULL")
        groups = rest.agg(F.max("part")).first()[0]
        if groups is None:
            break
        level += 1
        last = groups < MERGED
        grouped = rest.withColumn("group", F.floor(F.col("part") / MERGED))
        packed = materialise(grouped.groupBy("group").applyInArrow(merge(level, last), fields), "packed")
        done = done.unionByName(packed.filter("part IS NULL"))
    kept = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return done.select(F.col("key").alias(key), *kept)
