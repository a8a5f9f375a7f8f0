"""Records of large CSV files whose quoted fields hold newlines, read by many tasks.

Spark cuts a file into byte ranges and gives the lines that begin in each. Whether a
line stands inside a quoted field depends on the number of quotes before it, so the
quotes of every range are counted, and a prefix sum over a file's ranges says which
of them begin inside a field. Then every range finds its records by itself; the two
that its borders cut are put together from their pieces. Fields are parsed by Spark.

This holds for files as RFC 4180 describes them: a quote only around a field, or
doubled inside a quoted one. A file with an odd number of quotes is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.sources.storage import materialise

QUOTE = '"'
#: Kinds of pieces: the end of a record begun in an earlier range, a range inside one field, the begin of a record.
HEAD, MIDDLE, TAIL = 0, 1, 2


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(h, value, file, start): lines in order within a byte range, which ``h`` names."""
    lines = spark.read.text(path, lineSep="\n")
    place = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return place.select(F.xxhash64("file", "start").alias("h"), "value", "file", "start")


def byte_ranges(lines: DataFrame) -> DataFrame:
    """A written table (file, start, h, inside): the ranges, and whether each begins inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy("file", "start", "h").agg(F.sum(quotes).alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    return materialise(counted.select("file", "start", "h", "quotes", inside.alias("inside")), "ranges")


class _Range:
    """Cuts the lines of one byte range into records, batch by batch."""

    def __init__(self, inside: bool):
        self.inside = inside  # at the next line
        self.begun_before = inside  # the open lines belong to a record of an earlier range
        self.open: list[str] = []
        self.head: str | None = None
        self.records = 0

    def add(self, values: pa.Array) -> list[str]:
        """The records that end in these lines."""
        parity = (self.inside + np.cumsum(pc.count_substring(values, QUOTE).to_numpy())) % 2
        before = np.concatenate(([int(self.inside)], parity[:-1]))
        lines, done = values.to_pylist(), []
        begins = np.flatnonzero(before == 0).tolist()
        first = begins[0] if begins else len(lines)
        self.open += lines[:first]
        if begins and (self.open or self.begun_before):
            done += self._close()
        for at, to in zip(begins, [*begins, len(lines)][1:], strict=True):
            if to < len(lines) or not parity[-1]:
                done.append(lines[at] if to == at + 1 else "\n".join(lines[at:to]))
            else:
                self.open = lines[at:to]
        if not begins and not parity[-1]:
            done += self._close()
        self.inside = bool(parity[-1])
        self.records += len(done)
        return done

    def _close(self) -> list[str]:
        text, self.open = "\n".join(self.open), []
        if self.begun_before:
            self.head, self.begun_before = text, False
            return []
        return [text]

    def pieces(self) -> list[tuple[int, str]]:
        """(kind, text) of what the range's borders cut."""
        made = [(HEAD, self.head)] if self.head is not None else []
        if self.inside:
            made.append((MIDDLE if self.begun_before else TAIL, "\n".join(self.open)))
        return made


def _cut(inside: np.ndarray, whole: bool):
    """Function from (h, value, zero) lines to whole records (header, record) or to pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cutter, zero = None, None, False
        for batch in batches:
            names, values = batch.column(0).to_numpy(), batch.column(1)
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if start == stop:
                    continue
                if names[start] != at:
                    if cutter and not whole:
                        yield from _pieces(at, zero, cutter)
                    at, zero = names[start], batch.column(2)[start].as_py()
                    place = np.searchsorted(inside, at)
                    cutter = _Range(bool(place < len(inside) and inside[place] == at))
                earlier = cutter.records
                done = cutter.add(values.slice(start, stop - start))
                if whole and done:
                    header = np.zeros(len(done), bool)
                    header[0] = zero and not earlier
                    yield pa.RecordBatch.from_arrays([pa.array(header), pa.array(done)], names=["header", "record"])
        if cutter and not whole:
            yield from _pieces(at, zero, cutter)

    return run


def _pieces(at: int, zero: bool, cutter: _Range) -> Iterator[pa.RecordBatch]:
    made = cutter.pieces()
    if made:
        kinds, texts = zip(*made, strict=True)
        header = [zero and not cutter.records and kind == TAIL for kind in kinds]
        columns = [pa.array([at] * len(made), pa.int64()), pa.array(kinds, pa.int32()), pa.array(header), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["h", "kind", "header", "text"])


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(record, header): every record as one string, blank lines left out; ``header`` marks the first of each file.

    The files are read three times: for the quotes, for the pieces at the borders of
    ranges, and, when the result is used, for all other records. Eight bytes reach
    the driver for a range that begins inside a field.
    """
    lines = _lines(spark, path)
    ranges = byte_ranges(lines)
    odd = ranges.groupBy("file").agg((F.sum("quotes") % 2).alias("odd")).filter("odd = 1").select("file").limit(3).collect()
    if odd:
        raise ValueError(f"Quotes do not pair in {[r['file'] for r in odd]}: read it as a whole (ranged=False)")
    inside = np.sort(np.array([r["h"] for r in ranges.filter("inside").select("h").collect()], np.int64))
    named = lines.select("h", "value", (F.col("start") == 0).alias("zero"))
    pieces = materialise(named.mapInArrow(_cut(inside, False), "h bigint, kind int, header boolean, text string"), "pieces")
    place = pieces.join(ranges.select("h", "file", "start"), "h")
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum((F.col("kind") == TAIL).cast("int")).over(order)
    texts = F.array_sort(F.collect_list(F.struct("start", "kind", "text")))
    stitched = (
        place.withColumn("number", number).groupBy("file", "number")
        .agg(texts.alias("texts"), F.bool_or("header").alias("header"))
        .select("header", F.array_join(F.col("texts.text"), "\n").alias("record"))
    )
    every = named.mapInArrow(_cut(inside, True), "header boolean, record string").unionByName(stitched)
    # Where lines end with a carriage return and a newline, Spark reads both as a newline inside fields too.
    plain = F.replace(F.regexp_replace("record", "\r\\z", ""), F.lit("\r\n"), F.lit("\n"))
    record = F.when(F.endswith("record", F.lit("\r")), plain).otherwise(F.col("record"))
    return every.withColumn("record", record).filter("record <> ''")
