"""CSV landing, typed coercion, silver and gold tables, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.bindings import (
    GOLD_RECIPES_SQL, GOLD_REVIEWS_SQL, SILVER_INTERACTIONS_SQL, SILVER_RECIPES_SQL,
    raw_interactions, raw_recipes,
)
from tagloom.catalog.registry import query, table
from tagloom.functions import parsing
from tagloom.operators import cleaning, gold
from tagloom.operators.contracts import keep_or_derive
from tagloom.plans.ingest import land
from tagloom.sources import csv_files
from tagloom.sources.storage import missing_paths, scan, scratch_path, write_if_absent, write_table


def _as_csv(df, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.options(
        header=True, quote='"', escape='"', quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def _reviews_csv(spark, folder) -> str:
    """Documents in the interactions layout, texts with newlines and quotes."""
    docs = table(spark, folder, "documents")
    return _as_csv(
        docs.select(
            F.col("doc_id").alias("user_id"),
            F.col("n_chars").alias("recipe_id"),
            F.lit("2020-01-01").alias("date"),
            F.when(F.col("doc_id") % 31 == 0, "five").otherwise("5").alias("rating"),
            F.col("text").alias("review"),
        ),
        "reviews-csv",
    )


TYPED_SQL = (
    "SELECT doc_id AS user_id, n_chars AS recipe_id, CASE WHEN doc_id % 31 <> 0 THEN 5::BIGINT END AS rating, "
    "md5(text) AS digest, doc_id % 31 = 0 AS corrupt FROM documents"
)


def _typed(rows):
    return rows.select(
        "user_id", "recipe_id", "rating", F.md5("review").alias("digest"),
        F.col(csv_files.CORRUPT_COLUMN).isNotNull().alias("corrupt"),
    )


@query(TYPED_SQL)
def csv_typed_scan(spark, folder):
    """Typed scan of multi-line records; an unreadable rating marks its record."""
    return _typed(csv_files.scan_interactions(spark, _reviews_csv(spark, folder)))


@query(TYPED_SQL)
def csv_ranged_typed_scan(spark, folder):
    """The same from byte ranges of the files, so that one file is read by many tasks."""
    return _typed(csv_files.scan_interactions(spark, _reviews_csv(spark, folder), ranged=True))


@query(
    "SELECT p_name AS name, p_partkey AS id, CASE WHEN p_partkey % 17 <> 0 THEN p_size::BIGINT END AS minutes, "
    "'line one\nline \"two\" of ' || p_name AS steps, p_partkey % 17 = 0 AS corrupt FROM part"
)
def recipe_csv_scan(spark, folder):
    """Typed scan of recipes whose steps hold newlines and quotes; unreadable minutes mark their record."""
    k, text = F.col("p_partkey"), F.lit("['x']")
    steps = F.concat(F.lit('line one\nline "two" of '), F.col("p_name"))
    raw = table(spark, folder, "part").select(
        F.col("p_name").alias("name"), k.alias("id"), F.when(k % 17 == 0, "soon").otherwise(F.col("p_size").cast("string")).alias("minutes"),
        F.lit(1).alias("contributor_id"), F.lit("2001-02-03").alias("submitted"), text.alias("tags"), text.alias("nutrition"),
        F.lit(2).alias("n_steps"), steps.alias("steps"), F.col("p_type").alias("description"), text.alias("ingredients"), F.lit(2).alias("n_ingredients"),
    )
    rows = csv_files.scan_recipes(spark, _as_csv(raw, "recipes-csv"))
    return rows.select("name", "id", "minutes", "steps", F.col(csv_files.CORRUPT_COLUMN).isNotNull().alias("corrupt"))


UNTYPED_SQL = (
    "SELECT CAST(doc_id AS VARCHAR) AS user_id, CASE WHEN doc_id % 31 = 0 THEN 'five' ELSE '5' END AS rating, "
    "length(text) AS n FROM documents"
)


@query(UNTYPED_SQL)
def csv_untyped_scan(spark, folder):
    rows = csv_files.scan_untyped(spark, _reviews_csv(spark, folder))
    return rows.select("user_id", "rating", F.length("review").cast("long").alias("n"))


@query(UNTYPED_SQL)
def csv_ranged_untyped_scan(spark, folder):
    rows = csv_files.scan_untyped(spark, _reviews_csv(spark, folder), ranged=True)
    return rows.select("user_id", "rating", F.length("review").cast("long").alias("n"))


@query(
    "SELECT 'landed' AS part, count(*) AS n FROM documents "
    "UNION ALL SELECT 'good', count(*) FROM documents WHERE doc_id % 31 <> 0 "
    "UNION ALL SELECT 'quarantined', count(*) FROM documents WHERE doc_id % 31 = 0"
)
def landed_counts(spark, folder):
    """Land a CSV as parquet, count it, split off corrupt records."""
    path = scratch_path(spark, "bronze")
    rows = land(csv_files.scan_interactions(spark, _reviews_csv(spark, folder)), path)
    good, bad = csv_files.split_corrupt(scan(spark, path))
    counted = good.agg(F.lit("good").alias("part"), F.count(F.lit(1)).alias("n"))
    quarantined = bad.agg(F.lit("quarantined").alias("part"), F.count(F.lit(1)).alias("n"))
    landed = counted.select(F.lit("landed").alias("part"), F.lit(rows).cast("long").alias("n"))
    return landed.union(counted).union(quarantined)


@query(
    "SELECT 'documents' AS input, count(*) AS n, false AS missing FROM documents "
    "UNION ALL SELECT 'orders', count(*), false FROM orders UNION ALL SELECT 'unheard_of', 0, true"
)
def required_inputs(spark, folder):
    """Inputs checked before a job starts; what is missing is named, what is there is read."""
    names = ("documents", "unheard_of", "orders")
    paths = {name: f"{folder}/{name}.parquet" for name in names}
    missing = missing_paths(spark, *paths.values())
    counts = [
        spark.range(1).select(F.lit(0).cast("bigint").alias("n")) if path in missing
        else scan(spark, path).agg(F.count(F.lit(1)).alias("n")) for path in paths.values()
    ]
    rows = [c.select(F.lit(name).alias("input"), "n", F.lit(paths[name] in missing).alias("missing")) for name, c in zip(names, counts, strict=True)]
    return rows[0].union(rows[1]).union(rows[2])


@query("SELECT o_orderkey, '' AS review_clean, CAST(1 AS INTEGER) AS token_count FROM orders")
def review_text_absent(spark, folder):
    """A table without the text column gets an empty text, which counts as one token."""
    rows = cleaning.with_clean_review(table(spark, folder, "orders"))
    return cleaning.with_token_count(rows).select("o_orderkey", "review_clean", "token_count")


@query("SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def partitioned_sink(spark, folder):
    """Write partitioned by language with balanced files, read back."""
    path = scratch_path(spark, "by-lang")
    write_table(table(spark, folder, "documents"), path, partition_by=["lang"], balance=True)
    rows = scan(spark, path)
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def sink_kept_if_present(spark, folder):
    """A second write to the same table is skipped unless forced."""
    path = scratch_path(spark, "orders")
    orders = table(spark, folder, "orders")
    write_if_absent(orders, path)
    write_if_absent(orders.filter(F.col("o_orderstatus") == "F"), path)
    return scan(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL")
def contract_scan(spark, folder):
    rows = scan(spark, f"{folder}/labels.parquet", required=["doc_id", "quality"], not_null=["doc_id", "quality"])
    return rows.select("doc_id", "quality")


@query(
    """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE substr(o_orderpriority, 1, 1) END AS DOUBLE)
         AS priority,
       CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS day
FROM orders"""
)
def try_casts(spark, folder):
    """Casts that give null on text that does not fit."""
    orders = table(spark, folder, "orders")
    number = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.substring("o_orderpriority", 1, 1)
    )
    text = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return orders.select("o_orderkey", parsing.as_number(number).alias("priority"), parsing.as_day(text).alias("day"))


@query(f"WITH {SILVER_INTERACTIONS_SQL} SELECT * FROM silver_interactions")
def silver_interactions(spark, folder):
    return cleaning.clean_interactions(raw_interactions(spark, folder)).drop("review")


@query(f"WITH {SILVER_RECIPES_SQL} SELECT * FROM silver_recipes")
def silver_recipes(spark, folder):
    rows = cleaning.clean_recipes(raw_recipes(spark, folder))
    return rows.drop("tags", "nutrition", "steps", "description", "ingredients")


@query(
    "SELECT doc_id, n_chars % 6 AS rating FROM documents "
    "WHERE doc_id % 41 <> 0 AND doc_id % 31 <> 0 AND n_chars % 6 <> 0"
)
def sentinel_filter(spark, folder):
    """Typed rows without null keys and without the 'no rating' value."""
    rows = cleaning.coerce_interactions(raw_interactions(spark, folder))
    return rows.select("doc_id", F.col("rating").cast("long").alias("rating"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity >= 4 AS INTEGER) AS liked FROM lineitem"
)
def derived_liked(spark, folder):
    rows = gold.with_liked(table(spark, folder, "lineitem"), "l_quantity")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "liked")


@query(
    "SELECT d.doc_id, CASE WHEN l.quality IS NOT NULL THEN l.quality ELSE CAST(d.n_chars > 500 AS INTEGER) END "
    "AS quality FROM documents d LEFT JOIN labels l USING (doc_id)"
)
def derive_unless_present(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"))
    rows = table(spark, folder, "documents").join(labels, "doc_id", "left")
    return keep_or_derive(rows, "quality", (F.col("n_chars") > 500).cast("int")).select("doc_id", "quality")


def _gold_reviews(spark, folder):
    return gold.gold_reviews(cleaning.clean_interactions(raw_interactions(spark, folder)))


def _gold_recipes(spark, folder):
    return gold.gold_recipes(cleaning.clean_recipes(raw_recipes(spark, folder)))


@query(f"WITH {GOLD_REVIEWS_SQL} SELECT * FROM gold_reviews")
def gold_reviews(spark, folder):
    return _gold_reviews(spark, folder)


@query(f"WITH {GOLD_RECIPES_SQL} SELECT * FROM gold_recipes")
def gold_recipes(spark, folder):
    return _gold_recipes(spark, folder)


@query(
    f"WITH {GOLD_REVIEWS_SQL}, {GOLD_RECIPES_SQL} SELECT * FROM gold_reviews JOIN gold_recipes USING (recipe_id)"
)
def gold_wide(spark, folder):
    return gold.gold_wide(_gold_reviews(spark, folder), _gold_recipes(spark, folder))


@query(
    f"WITH {GOLD_REVIEWS_SQL}, {GOLD_RECIPES_SQL} "
    "SELECT * EXCLUDE (user_id, review_key) FROM gold_reviews JOIN gold_recipes USING (recipe_id)"
)
def vector_view(spark, folder):
    return gold.vector_view(gold.gold_wide(_gold_reviews(spark, folder), _gold_recipes(spark, folder)))


@query(
    f"WITH {GOLD_REVIEWS_SQL}, {GOLD_RECIPES_SQL} "
    "SELECT user_id, recipe_id, rating FROM gold_reviews JOIN gold_recipes USING (recipe_id)"
)
def ratings_view(spark, folder):
    return gold.ratings_view(gold.gold_wide(_gold_reviews(spark, folder), _gold_recipes(spark, folder)))
