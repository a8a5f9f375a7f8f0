"""Text functions and text features over documents."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tagloom.catalog.bindings import clean_documents, raw_interactions, sql_clean, sql_strings
from tagloom.catalog.registry import query, table
from tagloom.functions import text
from tagloom.operators.cleaning import with_min_tokens, within_token_band
from tagloom.operators.gold import with_review_key
from tagloom.operators.selection import RISK_WORDS, conflict_candidates
from tagloom.operators.text_features import (
    TextSpec, capped_tfidf_terms, dealt, drop_token_columns, embed_by_join, nearest_words, tfidf_stages, tfidf_terms,
    token_stages, top_terms,
)
from tagloom.sources.storage import materialise, scratch_path

# Spark's 181 English stopwords, restated for the SQL side.
STOPWORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing a an
the and but if or because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again further then once
here there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd
you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've
isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's
where's who's why's would""".split()
SQL_STOPWORDS = sql_strings([w for w in STOPWORDS if w not in text.NEGATIONS])
CLEAN = sql_clean("text")
SQL_TOKENS = rf"""
tokens AS (
  SELECT doc_id, list_filter(regexp_extract_all({CLEAN}, '\w+'), lambda t: len(t) >= 2) AS tokens FROM documents
),
kept AS (
  SELECT doc_id, tokens, list_filter(tokens, lambda t: NOT list_contains({SQL_STOPWORDS}, t)) AS kept FROM tokens
)"""
RARE_WORDS = ["rewh", "thatin", "hehely", "leaux"]


@query(f"SELECT doc_id, {CLEAN} AS review_clean FROM documents")
def normalize_text(spark, folder):
    return clean_documents(spark, folder).select("doc_id", "review_clean")


@query(
    f"SELECT doc_id, sha256(doc_id::VARCHAR || '||' || source || '||' || lang || '||' || {CLEAN}) AS review_key "
    "FROM documents"
)
def row_key_sha256(spark, folder):
    docs = clean_documents(spark, folder)
    return with_review_key(docs, ("doc_id", "source", "lang", "review_clean")).select("doc_id", "review_key")


@query(
    "SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS token_count FROM documents "
    "WHERE len(string_split(text, ' ')) BETWEEN 15 AND 120"
)
def token_band_filter(spark, folder):
    docs = table(spark, folder, "documents")
    return within_token_band(docs, "text").select("doc_id", "token_count")


@query(
    rf"SELECT * FROM (SELECT doc_id, CAST(len(regexp_split_to_array({CLEAN}, '\s+')) AS INTEGER) AS token_count "
    "FROM documents) WHERE token_count >= 15"
)
def min_token_filter(spark, folder):
    return with_min_tokens(clean_documents(spark, folder)).select("doc_id", "token_count")


@query("SELECT doc_id, length(text) AS n, length(trim(text)) = 0 AS blank FROM documents")
def text_length(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        text.char_length(F.col("text")).cast("long").alias("n"),
        text.is_blank(F.col("text")).alias("blank"),
    )


@query(
    rf"""
WITH raw AS (SELECT doc_id, doc_id % 31 = 0 AS bad_rating, n_chars % 6 AS rating, {CLEAN} AS review_clean
             FROM documents)
SELECT doc_id FROM raw
WHERE NOT bad_rating AND rating >= 4 AND regexp_matches(review_clean, '\b({"|".join(RARE_WORDS)})\b')"""
)
def keyword_conflict(spark, folder):
    rows = raw_interactions(spark, folder).select(
        "doc_id",
        F.col("rating").try_cast("double").alias("rating"),
        text.clean_text(F.col("review")).alias("review_clean"),
    )
    return conflict_candidates(rows, RARE_WORDS).select("doc_id")


RISKS = [w for words in RISK_WORDS.values() for w in words]


@query(
    rf"""
WITH raw AS (SELECT doc_id, doc_id % 31 = 0 AS bad_rating, n_chars % 6 AS rating,
                    {CLEAN} || ' ' || {sql_strings(RISKS)}[doc_id % {len(RISKS) + 3} + 1] AS review_clean FROM documents)
SELECT doc_id FROM raw WHERE NOT bad_rating AND rating >= 4 AND regexp_matches(review_clean, '\b({"|".join(RISKS)})\b')"""
)
def keyword_conflict_default_words(spark, folder):
    """The default risk words, one of them put behind most texts."""
    word = F.get(F.array(*[F.lit(w) for w in RISKS]), (F.col("doc_id") % (len(RISKS) + 3)).cast("int"))
    rows = raw_interactions(spark, folder).select(
        "doc_id", F.col("rating").try_cast("double").alias("rating"),
        F.concat(text.clean_text(F.col("review")), F.lit(" "), word).alias("review_clean"),
    )
    return conflict_candidates(rows).select("doc_id")


@query("SELECT count(*) AS bad_ids FROM documents WHERE doc_id % 31 = 0")
def malformed_ids(spark, folder):
    rows = raw_interactions(spark, folder)
    return rows.filter(text.looks_textual(F.col("rating"))).agg(F.count(F.lit(1)).alias("bad_ids"))


@query(f"WITH {SQL_TOKENS} SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM tokens")
def regex_tokens(spark, folder):
    tokens = text.word_tokens(F.col("review_clean"))
    return clean_documents(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query(
    f"WITH {SQL_TOKENS} SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, "
    "CAST(len(kept) AS INTEGER) AS n_kept FROM kept"
)
def stopword_filtered_counts(spark, folder):
    tokens = text.word_tokens(F.col("review_clean"))
    rows = clean_documents(spark, folder).select("doc_id", tokens.alias("tokens"))
    kept = text.without_words(F.col("tokens"), text.stopword_list())
    return rows.select("doc_id", F.size("tokens").alias("n_tokens"), F.size(kept).alias("n_kept"))


@query(
    f"""
WITH words AS (SELECT string_split({CLEAN}, ' ') AS w FROM documents),
grams AS (SELECT unnest(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) AS term FROM words)
SELECT term, count(*) AS n FROM grams GROUP BY term ORDER BY n DESC, term LIMIT 10"""
)
def top_bigrams(spark, folder):
    docs = dealt(clean_documents(spark, folder).select("review_clean"))
    words = docs.select(text.space_tokens(F.col("review_clean")).alias("words"))
    return top_terms(words.select(text.ngrams(F.col("words"), 2).alias("grams")), "grams", 10)


@query(
    f"WITH {SQL_TOKENS} SELECT doc_id, CAST(len(kept) + greatest(len(kept) - 2, 0) AS INTEGER) AS n_terms FROM kept"
)
def token_union_size(spark, folder):
    spec = TextSpec(ngram=3)
    docs = clean_documents(spark, folder).select("doc_id", "review_clean")
    prepared = token_stages(spec).fit(docs).transform(docs)
    return drop_token_columns(prepared.withColumn("n_terms", F.size(spec.terms)), spec).select("doc_id", "n_terms")


@query(
    f"""
WITH {SQL_TOKENS},
grams AS (SELECT doc_id, list_concat(kept, list_transform(list_zip(kept[:-2], kept[2:]), lambda p: p[1] || ' ' || p[2])) AS terms
          FROM kept)
SELECT doc_id, CAST(len(terms) AS INTEGER) AS n_terms, md5(array_to_string(terms, '|')) AS digest FROM grams"""
)
def saved_token_stages(spark, folder):
    """Token stages after a save and a load."""
    path = scratch_path(spark, "prep")
    docs = clean_documents(spark, folder).select("doc_id", "review_clean")
    token_stages().fit(docs).write().save(path)
    terms = PipelineModel.load(path).transform(docs)
    return terms.select(
        "doc_id", F.size("tokens_all").alias("n_terms"), F.md5(F.array_join("tokens_all", "|")).alias("digest")
    )


@query(
    f"""
WITH {SQL_TOKENS},
counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(kept) AS term FROM kept) GROUP BY ALL),
frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY term)
SELECT doc_id, term, tf, df,
       round(tf * CASE WHEN df >= 2 THEN ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) ELSE 0 END, 6) AS tfidf
FROM counts JOIN frequency USING (term)"""
)
def tfidf_by_term(spark, folder):
    kept = text.without_words(text.word_tokens(F.col("review_clean")), text.stopword_list())
    rows = clean_documents(spark, folder).select("doc_id", kept.alias("kept"))
    return tfidf_terms(rows, "doc_id", "kept").withColumn("tfidf", F.round("tfidf", 6))


@query(
    f"WITH {SQL_TOKENS} SELECT doc_id, CAST(len(kept) + greatest(len(kept) - 1, 0) AS DOUBLE) AS n_terms, true AS weighed FROM kept"
)
def tfidf_hashed(spark, folder):
    """Hashed TF-IDF. Buckets exist only in Spark; the hashed counts of a row sum to its terms, and each has its weight."""
    spec = TextSpec()
    docs = clean_documents(spark, folder).select("doc_id", "review_clean")
    prepared = token_stages(spec).fit(docs).transform(docs)
    terms = materialise(prepared.select("doc_id", spec.terms), "terms")
    weighed = tfidf_stages(spec).fit(terms).transform(terms)
    # The stored parts of the sparse vectors, not arrays of all buckets.
    counts, weights = F.unwrap_udt(f"{spec.tfidf}_tf"), F.unwrap_udt(spec.tfidf)
    total = F.aggregate(counts["values"], F.lit(0.0), lambda a, x: a + x)
    same = (weights["size"] == spec.hash_buckets) & (weights["indices"] == counts["indices"]) & F.forall(weights["values"], lambda x: x >= 0)
    return weighed.select("doc_id", total.alias("n_terms"), same.alias("weighed"))


# A word's vector here is (length, first digest digit) over a prime, so that no
# mean falls on a rounding boundary.
@query(
    f"""
WITH {SQL_TOKENS},
words AS (SELECT doc_id, unnest(kept) AS word FROM kept),
known AS (SELECT doc_id, length(word) / 9973.0::DOUBLE AS a, ('0x' || substr(md5(word), 1, 1))::INTEGER / 9973.0::DOUBLE AS b
          FROM words WHERE length(word) % 3 <> 0),
sums AS (SELECT doc_id, sum(a) AS a, sum(b) AS b FROM known GROUP BY doc_id)
SELECT doc_id, round(CASE WHEN len(kept) = 0 THEN 0 ELSE coalesce(a, 0) / len(kept) END, 9) AS e0,
       round(CASE WHEN len(kept) = 0 THEN 0 ELSE coalesce(b, 0) / len(kept) END, 9) AS e1
FROM kept LEFT JOIN sums USING (doc_id)"""
)
def embed_from_table(spark, folder):
    """Document vectors from a table of word vectors (here derived from the words)."""
    kept = text.without_words(text.word_tokens(F.col("review_clean")), text.stopword_list())
    rows = materialise(clean_documents(spark, folder).select("doc_id", kept.alias("kept")), "kept")
    digit = F.conv(F.substring(F.md5("word"), 1, 1), 16, 10).cast("double") / 9973.0
    words = rows.select(F.explode("kept").alias("word")).distinct().filter(F.length("word") % 3 != 0)
    vectors = words.select("word", F.array(F.length("word") / 9973.0, digit).alias("vector"))
    out = embed_by_join(rows, vectors, key="doc_id", tokens="kept", out="e", size=2)
    return out.select("doc_id", *[F.round(F.get("e", F.lit(i)), 9).alias(f"e{i}") for i in range(2)])


@query(
    f"""
WITH {SQL_TOKENS},
counts AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(kept) AS term FROM kept) GROUP BY ALL),
totals AS (SELECT term, sum(tf) AS n, count(*) AS df FROM counts GROUP BY term),
ranked AS (SELECT term, df, row_number() OVER (ORDER BY n DESC, term) AS place FROM totals),
frequent AS (SELECT term, df FROM ranked WHERE place <= greatest(1, CAST(floor(0.33 * (SELECT count(*) FROM totals)) AS BIGINT)))
SELECT doc_id, term, tf, df, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS tfidf
FROM counts JOIN frequent USING (term)"""
)
def capped_vocabulary_tfidf(spark, folder):
    """TF-IDF over the most frequent third of the terms; the vocabulary is a table."""
    kept = text.without_words(text.word_tokens(F.col("review_clean")), text.stopword_list())
    rows = clean_documents(spark, folder).select("doc_id", kept.alias("kept"))
    return capped_tfidf_terms(rows, "doc_id", "kept", share=0.33).withColumn("tfidf", F.round("tfidf", 6))


@query(
    f"""
WITH {SQL_TOKENS},
words AS (SELECT DISTINCT unnest(kept) AS word FROM kept),
vectors AS (SELECT word, length(word)::DOUBLE AS a, ('0x' || substr(md5(word), 1, 2))::INTEGER::DOUBLE AS b FROM words),
own AS (SELECT max(word) AS word, max_by(a, word) AS a, max_by(b, word) AS b FROM vectors)
SELECT v.word, round((v.a * o.a + v.b * o.b) / (sqrt(v.a * v.a + v.b * v.b) * sqrt(o.a * o.a + o.b * o.b)), 9) AS similarity
FROM vectors v, own o WHERE v.word <> o.word ORDER BY similarity DESC, v.word LIMIT 20"""
)
def word_neighbours(spark, folder):
    """Words closest to the last word of the alphabet, over a table of vectors derived from the words."""
    kept = text.without_words(text.word_tokens(F.col("review_clean")), text.stopword_list())
    words = clean_documents(spark, folder).select(F.explode(kept).alias("word")).distinct()
    digits = F.conv(F.substring(F.md5("word"), 1, 2), 16, 10).cast("double")
    vectors = materialise(words.select("word", F.array(F.length("word").cast("double"), digits).alias("vector")), "vectors")
    return nearest_words(vectors, vectors.agg(F.max("word")).first()[0], 20)
