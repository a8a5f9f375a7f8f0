"""Many-to-one joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.sources.storage import materialise

#: Plan nodes that cost little to run again: reading, choosing and computing columns and rows.
REPEATABLE = {"Project", "Filter", "Union", "Range", "LocalRelation", "LogicalRelation", "DataSourceV2ScanRelation"}
#: Bytes of rows of frequent keys that are broadcast, at most.
HOT_BYTES = 256 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a plan; nothing is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 switches broadcasts off."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def repeatable(df: DataFrame) -> bool:
    """Whether a plan only scans tables and works row by row, without Python and without chance."""

    def cheap(node) -> bool:
        children = [node.children().apply(k) for k in range(node.children().size())]
        return node.nodeName() in REPEATABLE and node.deterministic() and all(map(cheap, children))

    return cheap(df._jdf.queryExecution().optimizedPlan())


def join_to_one(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to a table with one row per key (``inner``, ``left`` or ``left_anti``).

    What Spark broadcasts by the session's threshold is left to Spark; larger
    tables go through ``join_split``. Both give the same rows.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"Unsupported join type: {how}")
    if estimated_bytes(one) <= broadcast_limit(one):
        return many.join(one, key, how)
    return join_split(many, one, key, how)


def join_split(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``join_to_one`` by a shuffle that frequent keys take no part in.

    A mergeable sketch of the key column finds the keys with more rows than an even
    share of a shuffle partition: at most as many as there are partitions. Their
    rows in ``one`` are written, checked to be at most ``HOT_BYTES``, and broadcast;
    the rows of ``many`` with such a key, and those without a key that the join
    keeps, stay where they are. All other rows meet by a shuffle on the key. If the rows
    of frequent keys are too large, every row is shuffled and skew is left to
    adaptive execution.

    ``many`` is read for the sketch (its key alone), for the rows that stay and for
    those that move. A plan that does more than scan, filter and compute columns is
    written once first.
    """
    source = many if repeatable(many) else materialise(many, "join")
    hot = frequent_key(source, key)
    present = F.col(key).isNotNull()
    few = materialise(one.filter(hot), "frequent")
    if estimated_bytes(few) > HOT_BYTES:
        hot, few = F.lit(False), few.limit(0)
    moving = source.filter(present & ~hot).join(one, key, how)
    staying = source.filter(hot if how == "inner" else hot | ~present).join(F.broadcast(few), key, how)
    return moving.unionByName(staying)


def frequent_key(df: DataFrame, key: str) -> Column:
    """Condition that holds for keys with more rows than an even share of a shuffle partition.

    It may hold for a few others: counts are estimates, and keys go by a 64-bit
    hash. Null keys are none. The sketch is Spark's ``approx_top_k``: each task
    counts a bounded number of keys, and those counts merge.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(max(1024, 16 * partitions), 1_000_000)
    top = F.expr(f"approx_top_k(h, {min(2 * partitions, tracked)}, {tracked})")
    hashed = df.filter(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"))
    found = hashed.agg(F.count(F.lit(1)).alias("rows"), top.alias("top")).first()
    share = found["rows"] / partitions * (1 - 1 / 8)  # less the sketch's error
    hashes = [r["item"] for r in found["top"] or [] if r["count"] > max(share, 1)]
    return F.col(key).isNotNull() & F.xxhash64(key).isin(hashes) if hashes else F.lit(False)
