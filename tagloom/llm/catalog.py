"""Registered queries of the subpackage: thin views of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, language, lexical, links, lm, packing, quality, shards, simhash, sketches, structure, toxicity, vectors
from tagloom.llm.common import table
from tagloom.sources.storage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def hex64(name: str) -> Column:
    """A 64-bit number as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(name), 16, "0"))


@query()
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, distance=4)
    return found.select("doc_id", hex64("fingerprint").alias("fingerprint"), "component_id")


@query()
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op5_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    path = shards.write_shards(table(spark, folder, "documents"), scratch_path(spark, "shards"), tokenizer, 2)
    return shards.read_shards(spark, path).withColumnRenamed("key", "doc_id")


@query()
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, folder, "documents"), tokenizer, 1, size=2048)


#: Rules of the url query, as its contract states them.
URL_RULES = (
    links.Rule("allow", "com", "/"),
    links.Rule("block", "example.com", "/en/"),
    links.Rule("allow", "www.example.com", "/en/"),
    links.Rule("block", "net", "/es/"),
    links.Rule("block", "net", "/fr/"),
)


@query()
def op7_link_trust(spark: SparkSession, folder: str) -> DataFrame:
    return links.judge(table(spark, folder, "pages"), URL_RULES)


@query()
def op9_scaled_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketches.compare_edited(table(spark, folder, "documents"))


@query()
def op10_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"), cosine=0.98)


@query()
def op3_subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op8_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op2_attention_lm(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    scored = lm.score_folds(table(spark, folder, "documents"), path)
    first = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select(*first, "attention_score")


#: The terms of a text in SQL; ``regexp_extract_all`` gives whole matches.
SQL_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{lexical.UPPER}', '{lexical.LOWER}'), '{lexical.TERM}')"


@query(
    f"""WITH items AS (SELECT DISTINCT item_id, unnest({SQL_TERMS}) AS term FROM benchmark),
docs AS (SELECT row_number() OVER () AS r, doc_id, {SQL_TERMS} AS terms FROM documents),
sizes AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM docs),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sizes WHERE n > 0),
counts AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term, nn),
norms AS (SELECT r, doc_id, 100 - 90 + ((90 * n * nn) // ll) AS m FROM sizes, totals),
scored AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM items JOIN counts USING (term) JOIN weights USING (term) JOIN norms USING (r) GROUP BY ALL),
placed AS (SELECT item_id, doc_id, score,
  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10"""
)
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op13_structure(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    made = structure.repair(structure.damaged(rows))
    found = made.audits.join(structure.repaired_digests(made.rows).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    every = rows.select(F.col("conv_id").alias("id")).distinct().join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        F.col("id").alias("conv_id"), *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query()
def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.classify(table(spark, folder, "documents"))
