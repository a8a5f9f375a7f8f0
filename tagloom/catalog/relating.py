"""Joins, set operations, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.bindings import LABELLED_DOCUMENTS_SQL, clean_documents, sql_clean, sql_split
from tagloom.catalog.registry import query, table
from tagloom.operators import gold, selection, splits
from tagloom.operators.cleaning import with_min_tokens
from tagloom.operators.joins import join_split


@query(
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, p_name, p_brand, p_retailprice "
    "FROM lineitem JOIN part ON l_partkey = p_partkey"
)
def wide_join(spark, folder):
    facts = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity"
    )
    dims = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_retailprice"
    )
    return gold.attach_by_key(facts, dims, "l_partkey")


@query(
    "SELECT CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_partkey END AS k, l_orderkey, l_linenumber, l_suppkey, p_name "
    "FROM lineitem JOIN part ON p_partkey = CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_partkey END"
)
def hot_key_join(spark, folder):
    """A third of the rows share one key, and the other side may not be broadcast."""
    facts = table(spark, folder, "lineitem").select(
        F.when(F.col("l_suppkey") % 3 == 0, 0).otherwise(F.col("l_partkey")).alias("k"),
        "l_orderkey", "l_linenumber", "l_suppkey",
    )
    dims = table(spark, folder, "part").select(F.col("p_partkey").alias("k"), "p_name")
    return join_split(facts, dims, "k")


@query(
    "SELECT k, p_name, count(*) AS n FROM (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE l_partkey END AS k FROM lineitem) "
    "JOIN part ON p_partkey = k GROUP BY ALL"
)
def hot_key_join_equal_rows(spark, folder):
    """Half of the rows are equal in all columns."""
    facts = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") % 2 == 0, 0).otherwise(F.col("l_partkey")).alias("k")
    )
    dims = table(spark, folder, "part").select(F.col("p_partkey").alias("k"), "p_name")
    return join_split(facts, dims, "k").groupBy("k", "p_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT k, l_orderkey, l_linenumber, p_name FROM (SELECT CASE WHEN l_linenumber % 5 = 0 THEN l_partkey END AS k, l_orderkey, l_linenumber "
    "FROM lineitem) LEFT JOIN part ON p_partkey = k"
)
def hot_key_join_left_nulls(spark, folder):
    """Most of the rows have no key and stay, unmatched."""
    facts = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") % 5 == 0, F.col("l_partkey")).alias("k"), "l_orderkey", "l_linenumber"
    )
    dims = table(spark, folder, "part").select(F.col("p_partkey").alias("k"), "p_name")
    return join_split(facts, dims, "k", "left")


@query("SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def attach_labels(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    return gold.attach_by_key(docs, table(spark, folder, "labels"), "doc_id").select(
        "doc_id", "lang", "quality", "toxic"
    )


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def exclude_labelled(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id")
    return selection.without_keys(docs, table(spark, folder, "labels"), "doc_id")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
def distinct_entities(spark, folder):
    return selection.distinct_keys(table(spark, folder, "orders"), "o_custkey")


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def composite_dedup(spark, folder):
    columns = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"]
    return table(spark, folder, "lineitem").select(*columns).distinct()


@query(
    """
WITH stacked AS (
  SELECT doc_id AS id, 0 AS frame, 0 AS turn, text FROM documents
  UNION ALL SELECT conv_id, 1, turn, text FROM conversations
)
SELECT id, turn, md5(text) AS digest
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY frame DESC, turn DESC, text DESC) AS rn FROM stacked)
WHERE rn = 1"""
)
def union_one_per_key(spark, folder):
    """Documents and conversation turns stacked; per id the last turn wins."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("turn"), "text"
    )
    turns = table(spark, folder, "conversations").select(F.col("conv_id").alias("id"), "turn", "text")
    kept = selection.one_per_key([docs, turns], "id", prefer=["turn", "text"])
    return kept.select("id", "turn", F.md5("text").alias("digest"))


@query(
    """
SELECT l_partkey, p_name, count(*) AS n_reviews, round(avg(l_quantity), 3) AS avg_rating,
       sum(CAST(l_quantity >= 4 AS INTEGER))::BIGINT AS n_liked
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_partkey, p_name ORDER BY n_reviews DESC, avg_rating DESC, l_partkey, p_name LIMIT 10"""
)
def top_entities(spark, folder):
    facts = gold.with_liked(table(spark, folder, "lineitem").select("l_partkey", "l_quantity"), "l_quantity")
    dims = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    joined = gold.attach_by_key(facts, dims, "l_partkey")
    return selection.top_groups(joined, ["l_partkey", "p_name"], "l_quantity", "liked")


@query(
    rf"""
SELECT doc_id, token_count FROM (
  SELECT doc_id, CAST(len(regexp_split_to_array({sql_clean('text')}, '\s+')) AS INTEGER) AS token_count
  FROM documents)
WHERE token_count >= 15 ORDER BY md5('42::' || doc_id), doc_id LIMIT 100"""
)
def hash_ordered_sample(spark, folder):
    """A fixed-size sample that does not depend on data layout."""
    docs = clean_documents(spark, folder)
    chosen = selection.sample_cut(with_min_tokens(docs).select("doc_id"), 100, "doc_id", seed=42)
    return with_min_tokens(docs.filter(chosen)).select("doc_id", "token_count")


@query("SELECT doc_id FROM labels WHERE toxic = 1 ORDER BY doc_id LIMIT 5")
def spot_check(spark, folder):
    rows = table(spark, folder, "labels").withColumnRenamed("toxic", "pred_toxic")
    return selection.examples_with_tag(rows, "toxic", "quality", "doc_id").select("doc_id")


@query(f"SELECT doc_id, source, {sql_split('source')} AS split FROM documents")
def entity_split(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return splits.assign_splits(docs, "source", method="md5")


@query("SELECT source, count(*) AS n, 1::BIGINT AS n_splits, true AS known FROM documents GROUP BY source")
def entity_split_xxhash(spark, folder):
    """The default hash: its values exist only in Spark, but every entity has one split."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return splits.assign_splits(docs, "source").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("split").alias("n_splits"),
        F.bool_and(F.col("split").isin("train", "val", "test")).alias("known"),
    )


@query(
    f"WITH {LABELLED_DOCUMENTS_SQL}, keyed AS (SELECT md5(text) AS k, source, split FROM labelled) "
    "SELECT k, min(source) AS source, arg_min(split, source) AS split FROM keyed GROUP BY k"
)
def split_table(spark, folder):
    """One split row per text, however often the text repeats."""
    docs = table(spark, folder, "documents").select(F.md5("text").alias("k"), "source")
    return splits.split_table(splits.assign_splits(docs, "source", method="md5"), "k", "source")
