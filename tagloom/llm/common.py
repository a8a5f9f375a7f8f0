"""What the operators share: text columns as bytes, small row slices, row filters by crc32."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(text: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def text_bytes(text: str) -> Column:
    """UTF-8 of the text column, null as empty."""
    return whole_text(text).cast("binary")


def remainder(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % of


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches, so that memory follows a few rows and not the batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def by_size(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a column together have at most ``most`` bytes, or are one text."""
    for batch in batches:
        start = held = 0
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def record(columns: Sequence[Sequence], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def unknown(memo: dict, wanted: set, limit: int) -> set:
    """Which of ``wanted`` the memo lacks; a memo that would outgrow ``limit`` starts anew first.

    Words follow a steep frequency curve, so a fresh start costs little and the
    results are the same: the bound is on memory alone. The memo must be a plain
    dict, whose difference costs as much as ``wanted`` and not as the memo.
    """
    new = wanted.difference(memo)
    if len(memo) + len(new) > limit:
        memo.clear()
        return wanted
    return new


def usable_labels(labels: DataFrame, label: str, held_out: Column, key: str) -> DataFrame:
    """(key, y): labels 0 and 1 of keys that are not null and not held out; of several the largest counts."""
    known = labels.select(F.col(key), F.col(label).cast("int").alias("y")).filter("y IN (0, 1)")
    return known.filter(F.col(key).isNotNull() & ~held_out).groupBy(key).agg(F.max("y").alias("y"))


def of_rows(known: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """The labelled keys that the table has; labels of other rows neither fill a sample nor weigh a class."""
    return known.join(docs.select(key).distinct(), key, "left_semi")


def teaches(known: DataFrame) -> bool:
    """Whether both classes are there to tell apart."""
    return known.select("y").distinct().count() == 2


def sampled_texts(docs: DataFrame, known: DataFrame, rows: int, *, key: str, text: str) -> DataFrame:
    """(t, y): texts of at most ``rows`` labelled keys, one each, chosen by a hash of the key."""
    chosen = known.orderBy(F.xxhash64(key), key).limit(rows)
    joined = docs.select(key, text_bytes(text).alias("t")).join(F.broadcast(chosen), key)
    return joined.groupBy(key).agg(F.min("t").alias("t"), F.max("y").alias("y")).select("t", "y")
