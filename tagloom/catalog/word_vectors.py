"""Word vectors factorised from pair counts, stated exactly.

Where the vectors have as many components as there are words, their inner products are
those of the table of weights, so lengths, neighbours, and the tags of documents have
values that SQL can state.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalog.bindings import CORPUS_TAXONOMY, WEAK_LABELS_SQL, clean_documents, sql_split
from tagloom.catalog.modelling import run_on_documents
from tagloom.catalog.registry import query
from tagloom.catalog.texts import SQL_TOKENS
from tagloom.functions import text
from tagloom.operators.text_features import TextSpec, corpus_size, embed_by_join, nearest_words, top_terms
from tagloom.operators.word_vectors import FactorSpec, cooccurrences, corpus_vectors, positive_pmi
from tagloom.plans.tagging import tag_corpus
from tagloom.sources.storage import forget, materialise

MIN_COUNT = 20


def sql_pmi(min_count: str) -> str:
    """CTE ``positive`` (word, context, n, pmi) behind ``kept``, for a window of three."""
    return f"""
frequent AS (SELECT word FROM (SELECT unnest(kept) AS word FROM kept) GROUP BY word HAVING count(*) >= {min_count}),
near AS (SELECT unnest(list_concat(list_concat(list_zip(kept[:-2], kept[2:]), list_zip(kept[:-3], kept[3:])),
                                   list_zip(kept[:-4], kept[4:]))) AS p FROM kept),
both_ways AS (SELECT p[1] AS word, p[2] AS context FROM near UNION ALL SELECT p[2], p[1] FROM near),
counts AS (SELECT word, context, count(*) AS n FROM both_ways
           WHERE word IN (SELECT word FROM frequent) AND context IN (SELECT word FROM frequent) GROUP BY ALL),
totals AS (SELECT word, sum(n)::DOUBLE AS total FROM counts GROUP BY word),
positive AS (
  SELECT * FROM (
    SELECT c.word, context, n, ln(n * (SELECT sum(total) FROM totals) / (a.total * b.total)) AS pmi
    FROM counts c JOIN totals a ON a.word = c.word JOIN totals b ON b.word = context)
  WHERE pmi > 0)"""


#: Words at least half as frequent as documents: few enough for a vector as wide as the vocabulary.
COMMON = "(SELECT count(*) // 2 FROM documents)"


def _tokens(spark, folder):
    kept = text.without_words(text.word_tokens(F.col("review_clean")), text.stopword_list())
    return clean_documents(spark, folder).select("doc_id", kept.alias("kept"))


def _kept(spark, folder):
    """Tokens written, for queries that read them more than once."""
    return materialise(_tokens(spark, folder), "kept")


def _whole_spec(tokens, column):
    """Vectors of all common words, as wide as their number."""
    common = max(tokens.count() // 2, 1)
    size = max(corpus_size(tokens, column, common)[0], 1)
    return FactorSpec(tokens=column, min_count=common, size=size, passes=1, exponent=1.0)


@query(f"WITH {SQL_TOKENS}, {sql_pmi(str(MIN_COUNT))} SELECT word, context, n, round(pmi, 9) AS pmi FROM positive")
def word_pmi(spark, folder):
    """Pairs of words that stand near each other more often than by chance."""
    pairs = cooccurrences(_tokens(spark, folder), FactorSpec(tokens="kept", min_count=MIN_COUNT))
    return positive_pmi(pairs).withColumn("pmi", F.round("pmi", 9))


@query(f"WITH {SQL_TOKENS}, {sql_pmi(COMMON)} SELECT word, round(sum(pmi * pmi), 6) AS squared FROM positive GROUP BY word")
def factorised_lengths(spark, folder):
    """Squared lengths of factorised word vectors are the squared weights of their words."""
    kept = _kept(spark, folder)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    return corpus_vectors(kept, _whole_spec(kept, "kept")).select("word", F.round(squares, 6).alias("squared"))


@query(
    f"""WITH {SQL_TOKENS}, {sql_pmi(COMMON)},
own AS (SELECT word FROM (SELECT unnest(kept) AS word FROM kept) GROUP BY word ORDER BY count(*) DESC, word LIMIT 1),
lengths AS (SELECT word, sqrt(sum(pmi * pmi)) AS length FROM positive GROUP BY word),
products AS (SELECT a.word, sum(a.pmi * b.pmi) AS product FROM positive a JOIN positive b ON a.context = b.context
             WHERE b.word = (SELECT word FROM own) GROUP BY a.word)
SELECT word, round(coalesce(product, 0) / (length * (SELECT length FROM lengths WHERE word = (SELECT word FROM own))), 6) AS similarity
FROM lengths LEFT JOIN products USING (word) WHERE word <> (SELECT word FROM own)"""
)
def factorised_neighbours(spark, folder):
    """All common words by their likeness to the commonest, from factorised vectors."""
    kept = _kept(spark, folder)
    spec = _whole_spec(kept, "kept")
    word = top_terms(kept, "kept", 1).first()["term"]
    found = nearest_words(corpus_vectors(kept, spec), word, spec.size)
    return found.select("word", F.round(F.col("similarity") + 0.0, 6).alias("similarity"))


# The weak labels have a ``tokens`` of their own.
SQL_KEPT = SQL_TOKENS.replace("tokens AS (", "all_tokens AS (").replace("FROM tokens", "FROM all_tokens")


@query(
    f"""WITH {SQL_KEPT}, {sql_pmi(COMMON)}, {WEAK_LABELS_SQL},
terms AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(kept) AS word FROM kept) GROUP BY ALL),
vectors AS (SELECT doc_id, context, sum(tf * pmi) / any_value(len(kept)) AS x
            FROM terms JOIN positive USING (word) JOIN kept USING (doc_id) GROUP BY doc_id, context),
lengths AS (SELECT doc_id, sqrt(sum(x * x)) AS length FROM vectors GROUP BY doc_id),
train AS (SELECT doc_id, unnest(labels) AS tag FROM documents JOIN weak USING (doc_id) WHERE {sql_split('source')} = 'train'),
sizes AS (SELECT tag, count(*) AS rows FROM train GROUP BY tag),
centroids AS (SELECT tag, context, sum(x) / any_value(rows) AS c FROM train JOIN vectors USING (doc_id) JOIN sizes USING (tag) GROUP BY tag, context),
centres AS (SELECT tag, sqrt(sum(c * c)) AS length FROM centroids GROUP BY tag),
products AS (SELECT doc_id, tag, sum(x * c) AS product FROM vectors JOIN centroids USING (context) GROUP BY doc_id, tag),
sims AS (
  SELECT doc_id, tag, coalesce(product / (l.length * m.length), 0) AS sim
  FROM (SELECT doc_id, tag FROM documents, sizes) LEFT JOIN products USING (doc_id, tag)
  LEFT JOIN lengths l USING (doc_id) LEFT JOIN centres m USING (tag)),
thresholds AS (SELECT tag, avg(sim) AS threshold FROM train JOIN sims USING (doc_id, tag) GROUP BY tag),
hits AS (SELECT doc_id, tag FROM sims JOIN thresholds USING (tag) WHERE sim >= threshold)
SELECT doc_id, count(tag)::INTEGER AS total_tags, coalesce(string_agg(tag, ',' ORDER BY tag), '') AS tags
FROM documents LEFT JOIN hits USING (doc_id) GROUP BY doc_id"""
)
def factorised_tagging(spark, folder):
    """Every document tagged by a run whose word vectors are a factorised table."""
    spec = TextSpec(ngram=1)
    kept = _kept(spark, folder)
    vectors = _whole_spec(kept.withColumnRenamed("kept", "tokens_all"), "tokens_all")
    forget(kept)
    base, run_id = run_on_documents(spark, folder, method="md5", vectors=vectors, text=spec)
    out = tag_corpus(spark, base, run_id, f"{base}/reviews", f"{base}/gold", tags=CORPUS_TAXONOMY.ids)
    return spark.read.parquet(out).select("doc_id", "total_tags", F.array_join(F.array_sort("tag_list"), ",").alias("tags"))


@query(
    f"""WITH {SQL_TOKENS}
SELECT doc_id, CAST(len(kept) AS INTEGER) AS n_terms, list_has_any(kept, (SELECT list(word) FROM (
  SELECT word FROM (SELECT unnest(kept) AS word FROM kept) GROUP BY word HAVING count(*) >= {MIN_COUNT}))) AS embedded FROM kept"""
)
def factorised_embedding(spark, folder):
    """Document vectors of usual width from factorised word vectors; only texts without a frequent word have zeros."""
    kept = _kept(spark, folder)
    model = corpus_vectors(kept, FactorSpec(tokens="kept", min_count=MIN_COUNT, size=64))
    rows = embed_by_join(kept, model, key="doc_id", tokens="kept", out="e", size=64)
    return rows.select("doc_id", F.size("kept").alias("n_terms"), F.exists("e", lambda x: x != 0).alias("embedded"))
