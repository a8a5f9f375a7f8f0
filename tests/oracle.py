"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, run, sql: str, folder: str) -> list[str]:
    """Empty when columns, types and rows agree."""
    df = run(spark, folder)
    relation = con.execute(sql)
    columns = [c[0] for c in relation.description]
    types = {c[0]: str(c[1]) for c in relation.description}
    expected = relation.fetchall()
    problems = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    names = {
        "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
    }
    for name, dtype in df.dtypes:
        if names.get(dtype, dtype) != types[name] and types[name] not in ("NUMBER", "STRING", "bool"):
            problems.append(f"type of {name}: {dtype} != {types[name]}")
    actual = [tuple(r) for r in df.collect()]
    got, want = _bag(df.columns, actual), _bag(columns, expected)
    if got != want:
        problems.append(f"rows {len(actual)} vs {len(expected)}")
        problems.append(f"only Spark: {list((got - want).items())[:3]}")
        problems.append(f"only SQL: {list((want - got).items())[:3]}")
    return problems
