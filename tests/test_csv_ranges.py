"""Records found by byte ranges against Spark's own reading of whole files."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom.sources import csv_files, csv_ranges

SCHEMA = "a long, b string, c string"


@pytest.fixture
def small_ranges(spark):
    """Ranges of 37 bytes, so that most records are cut, some more than once."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in zip(names, ("37", "0", "1"), strict=True):
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def make_file(path, rows, end="\n", last=True, seed=1):
    rng = random.Random(seed)
    fields = ['"x ""quoted"" y"', '"two\nlines"', '"', "plain", "", '""', '"a,b"', '"cr\r\nlf"', '"\n\n\n"', '"é漢 ""\n"" ende"', " spaced "]
    fields.remove('"')
    lines = ["a,b,c"]
    for k in range(rows):
        lines.append(",".join([rng.choice([str(k), "no number"]), rng.choice(fields), rng.choice([*fields, '"' + "long\n" * 30 + '"'])]))
        if rng.random() < 0.1:
            lines.append("")
    path.write_bytes((end.join(lines) + (end if last else "")).encode())


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("end,last", [("\n", True), ("\n", False), ("\r\n", True)])
def test_same_rows_as_whole_files(small_ranges, tmp_path, end, last):
    spark = small_ranges
    for k in range(2):
        make_file(tmp_path / f"{k}.csv", 40, end, last, seed=k)
    path = str(tmp_path)
    assert spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 20
    whole, ranged = (csv_files.scan_typed(spark, path, SCHEMA, ranged=r) for r in (False, True))
    assert whole.columns == ranged.columns
    assert bag(ranged.select("a", "b", "c")) == bag(whole.select("a", "b", "c"))
    corrupt = F.col(csv_files.CORRUPT_COLUMN).isNotNull().alias("corrupt")
    assert bag(ranged.select("a", "b", corrupt)) == bag(whole.select("a", "b", corrupt))
    texts = [csv_files.scan_untyped(spark, path, ranged=r) for r in (False, True)]
    assert texts[0].dtypes == texts[1].dtypes and bag(texts[0]) == bag(texts[1])


def test_one_record_over_many_ranges(small_ranges, tmp_path):
    spark = small_ranges
    text = "\n".join(f"line {k}" for k in range(500))
    (tmp_path / "one.csv").write_text(f'a,b,c\n1,"{text}",x\n2,y,z\n')
    rows = csv_files.scan_typed(spark, str(tmp_path / "one.csv"), SCHEMA, ranged=True)
    assert bag(rows.select("a", "b", "c")) == Counter([(1, text, "x"), (2, "y", "z")])


def test_header_cut_by_a_border(small_ranges, tmp_path):
    spark = small_ranges
    (tmp_path / "h.csv").write_text('"a\na","' + "b" * 50 + '\n",c\n1,2,3\n')
    rows = csv_files.scan_untyped(spark, str(tmp_path / "h.csv"), ranged=True)
    assert rows.columns == ["a\na", "b" * 50 + "\n", "c"] and bag(rows) == Counter([("1", "2", "3")])


def test_files_that_do_not_fit(small_ranges, tmp_path):
    spark = small_ranges
    (tmp_path / "odd.csv").write_text('a,b,c\n1,"open,x\n')
    with pytest.raises(ValueError, match="do not pair"):
        csv_files.scan_typed(spark, str(tmp_path / "odd.csv"), SCHEMA, ranged=True)
    (tmp_path / "many").mkdir()
    for k, header in enumerate(("a,b", "a,c")):
        (tmp_path / "many" / f"{k}.csv").write_text(f"{header}\n1,2\n")
    with pytest.raises(ValueError, match="Headers differ"):
        csv_files.scan_untyped(spark, str(tmp_path / "many"), ranged=True)


def test_empty_files(spark, tmp_path):
    (tmp_path / "header.csv").write_text("a,b,c\n")
    assert csv_files.scan_typed(spark, str(tmp_path / "header.csv"), SCHEMA, ranged=True).collect() == []
    (tmp_path / "nothing.csv").write_text("")
    assert csv_ranges.records(spark, str(tmp_path / "nothing.csv")).collect() == []
