"""The supplied tables seen as reviews, recipes and labelled vectors.

Each binding has a Spark form and a SQL form (``*_SQL``, a list of CTEs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.catalog.registry import table
from tagloom.functions.text import clean_text
from tagloom.operators.splits import assign_splits
from tagloom.operators.taxonomy import NEGATION_PAIRS, Tag, Taxonomy
from tagloom.operators.weak_labels import WeakLabelConfig

# --- SQL fragments -----------------------------------------------------------


def sql_clean(expr: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower(coalesce({expr}, '')), "
        r"'[^a-z0-9\s-]', ' ', 'g'), '\s+', ' ', 'g'))"
    )


def sql_unit_hash(expr: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5('{seed}::' || {expr}), 1, 8))::BIGINT % 10000) / 10000.0"


def sql_split(expr: str, seed: int = 42) -> str:
    u = sql_unit_hash(expr, seed)
    return (
        f"CASE WHEN {expr} IS NULL OR {u} < 0.8 THEN 'train' "
        f"WHEN {u} < 0.9 THEN 'val' ELSE 'test' END"
    )


def sql_strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# --- documents as raw interactions --------------------------------------------


def raw_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns as a CSV would give them, with unusable values mixed in."""
    doc = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (doc % 365).cast("int")), "yyyy-MM-dd")
    return table(spark, folder, "documents").select(
        "doc_id",
        (doc % 97).cast("string").alias("user_id"),
        F.when(doc % 41 != 0, (doc % 50).cast("string")).alias("recipe_id"),
        F.when(doc % 29 == 0, "2020/13/45").otherwise(day).alias("date"),
        F.when(doc % 31 == 0, "n/a").otherwise((F.col("n_chars") % 6).cast("string")).alias("rating"),
        F.col("text").alias("review"),
    )


RAW_INTERACTIONS_SQL = """
raw_interactions AS (
  SELECT doc_id,
         CAST(doc_id % 97 AS VARCHAR) AS user_id,
         CASE WHEN doc_id % 41 <> 0 THEN CAST(doc_id % 50 AS VARCHAR) END AS recipe_id,
         CASE WHEN doc_id % 29 = 0 THEN '2020/13/45'
              ELSE strftime(DATE '2020-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') END AS date,
         CASE WHEN doc_id % 31 = 0 THEN 'n/a' ELSE CAST(n_chars % 6 AS VARCHAR) END AS rating,
         text AS review
  FROM documents
)"""

SILVER_INTERACTIONS_SQL = f"""{RAW_INTERACTIONS_SQL},
silver_interactions AS (
  SELECT doc_id, user_id, recipe_id,
         CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date,
         TRY_CAST(rating AS DOUBLE) AS rating,
         {sql_clean('review')} AS review_clean,
         CAST(len(string_split(review, ' ')) AS INTEGER) AS token_count
  FROM raw_interactions
  WHERE recipe_id IS NOT NULL AND TRY_CAST(rating AS DOUBLE) <> 0
    AND len(string_split(review, ' ')) BETWEEN 15 AND 120
)"""

GOLD_REVIEWS_SQL = f"""{SILVER_INTERACTIONS_SQL},
gold_reviews AS (
  SELECT sha256(user_id || '||' || recipe_id || '||' || CAST(date AS VARCHAR) || '||' || review_clean) AS review_key,
         user_id, recipe_id, date, rating, CAST(rating >= 4 AS INTEGER) AS liked, review_clean
  FROM (SELECT DISTINCT user_id, recipe_id, date, rating, review_clean
        FROM silver_interactions WHERE date IS NOT NULL)
)"""

# --- part as raw recipes --------------------------------------------------------


def raw_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Part rows dressed as recipes with Python-style list literals."""
    k = F.col("p_partkey")
    quoted = F.concat(F.lit("['"), F.col("p_name"), F.lit("', \"baker's yeast\"]"))
    return table(spark, folder, "part").select(
        k.cast("string").alias("id"),
        F.when(k % 37 != 0, F.col("p_name")).alias("name"),
        F.when(k % 17 == 0, "soon").otherwise(F.col("p_size").cast("string")).alias("minutes"),
        (k % 7).cast("string").alias("contributor_id"),
        F.when(k % 19 == 0, "once").otherwise("2001-02-03").alias("submitted"),
        F.concat(F.lit("['"), F.lower("p_type"), F.lit("', '"), F.col("p_brand"), F.lit("']")).alias("tags"),
        F.when(k % 11 == 0, "[1.0, 2.0]")
        .otherwise(F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(", 1.5, 2.0, 3.0, 0.5, 7.25, 4]")))
        .alias("nutrition"),
        (F.col("p_size") % 7).cast("string").alias("n_steps"),
        F.concat(F.lit("['Mix the "), F.col("p_name"), F.lit("!', \"don't stop\"]")).alias("steps"),
        F.concat(F.col("p_name"), F.lit("!! "), F.col("p_type")).alias("description"),
        F.when(k % 13 == 0, "broken [").otherwise(quoted).alias("ingredients"),
        F.lit("2").alias("n_ingredients"),
    )


# The list literals above are known, so the SQL states what parsing must give.
SILVER_RECIPES_SQL = f"""
silver_recipes AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id,
         CASE WHEN p_partkey % 37 <> 0 THEN p_name END AS name,
         CASE WHEN p_partkey % 17 <> 0 THEN CAST(p_size AS DOUBLE) END AS minutes,
         CAST(p_partkey % 7 AS VARCHAR) AS contributor_id,
         CASE WHEN p_partkey % 19 <> 0 THEN TIMESTAMP '2001-02-03' END AS submitted,
         CAST(p_size % 7 AS DOUBLE) AS n_steps,
         2.0::DOUBLE AS n_ingredients,
         CASE WHEN p_partkey % 13 <> 0
              THEN replace({sql_clean('p_name')}, ' ', '_') || ' baker_s_yeast' END AS ingredients_clean,
         'mix the ' || {sql_clean('p_name')} || ' don t stop' AS steps_clean,
         {sql_clean('p_type')} || ' ' || {sql_clean('p_brand')} AS tags_clean,
         {sql_clean("p_name || '!! ' || p_type")} AS description_clean,
         CASE WHEN p_partkey % 11 = 0 THEN 1.0 ELSE CAST(p_size AS DOUBLE) END AS calories,
         CASE WHEN p_partkey % 11 = 0 THEN 2.0::DOUBLE ELSE 1.5::DOUBLE END AS fat,
         CASE WHEN p_partkey % 11 <> 0 THEN 2.0::DOUBLE END AS sugar,
         CASE WHEN p_partkey % 11 <> 0 THEN 3.0::DOUBLE END AS sodium,
         CASE WHEN p_partkey % 11 <> 0 THEN 0.5::DOUBLE END AS protein,
         CASE WHEN p_partkey % 11 <> 0 THEN 7.25::DOUBLE END AS saturated_fat,
         CASE WHEN p_partkey % 11 <> 0 THEN 4.0::DOUBLE END AS carbs
  FROM part
)"""

RECIPE_COLUMNS = (
    "name", "ingredients_clean", "steps_clean", "tags_clean", "description_clean", "minutes",
    "n_steps", "n_ingredients", "calories", "fat", "sugar", "sodium", "protein",
    "saturated_fat", "carbs",
)

GOLD_RECIPES_SQL = f"""{SILVER_RECIPES_SQL},
gold_recipes AS (
  SELECT id AS recipe_id, {", ".join(RECIPE_COLUMNS)}
  FROM silver_recipes
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in RECIPE_COLUMNS)}
)"""

# --- embeddings as labelled vectors -----------------------------------------------

CLASS_TAGS = [tag for pair in NEGATION_PAIRS for tag in pair]


def labelled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, split, tag, tags, features): each class is one of ten paired tags."""
    names = F.array(*[F.lit(t) for t in CLASS_TAGS])
    rows = table(spark, folder, "embeddings").select(
        "vec_id",
        F.get(names, F.col("label")).alias("tag"),
        F.col("embedding").alias("features"),
    )
    return assign_splits(rows, "vec_id", method="md5").withColumn("tags", F.array("tag"))


VECTORS_SQL = f"""
vectors AS (
  SELECT vec_id, {sql_strings(CLASS_TAGS)}[label + 1] AS tag,
         embedding::DOUBLE[] AS x, {sql_split('vec_id')} AS split
  FROM embeddings
)"""

CALIBRATION_SQL = f"""{VECTORS_SQL},
elements AS (
  SELECT tag, i, avg(x[i]) AS value
  FROM (SELECT tag, x, unnest(range(1, len(x) + 1)) AS i FROM vectors WHERE split = 'train')
  GROUP BY tag, i
),
centroids AS (SELECT tag, list(value ORDER BY i) AS c FROM elements GROUP BY tag),
thresholds AS (
  SELECT v.tag, count(*) AS pos_count, avg(list_cosine_similarity(x, c)) AS threshold
  FROM vectors v JOIN centroids USING (tag) WHERE split = 'train' GROUP BY v.tag
),
scores AS (
  SELECT vec_id, v.tag AS own, v.split, t.tag, list_cosine_similarity(x, c) AS sim
  FROM vectors v CROSS JOIN centroids t
),
hits AS (
  SELECT s.vec_id, s.own, s.split, s.tag, s.sim, CAST(s.sim >= threshold AS INTEGER) AS hit
  FROM scores s JOIN thresholds USING (tag)
)"""


def _resolved_case() -> str:
    """Pairwise pruning on long rows: the other side of each tag, if any."""
    rows = [f"('{p}', '{n}', TRUE)" for p, n in NEGATION_PAIRS]
    rows += [f"('{n}', '{p}', FALSE)" for p, n in NEGATION_PAIRS]
    return ", ".join(rows)


RESOLVED_SQL = f"""{CALIBRATION_SQL},
pairs(tag, other, positive) AS (VALUES {_resolved_case()}),
resolved AS (
  SELECT h.vec_id, h.own, h.split, h.tag, h.sim, h.hit,
         CASE WHEN h.hit = 1 AND o.hit = 1
               AND (CASE WHEN positive THEN h.sim <= o.sim ELSE h.sim < o.sim END)
              THEN 0 ELSE h.hit END AS kept
  FROM hits h JOIN pairs USING (tag)
  JOIN hits o ON o.vec_id = h.vec_id AND o.tag = pairs.other
)"""

# --- documents and labels as multi-label rows --------------------------------------

DOC_LABELS = ["quality", "toxic"]


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, source, lang, text, split, labels); labels null where unknown."""
    marks = F.array_compact(
        F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in DOC_LABELS])
    )
    known = table(spark, folder, "labels").select("doc_id", marks.alias("labels"))
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    return assign_splits(docs.join(known, "doc_id", "left"), "source", method="md5")


LABELLED_DOCUMENTS_SQL = f"""
labelled AS (
  SELECT d.doc_id, d.source, d.lang, d.text, {sql_split('d.source')} AS split,
         coalesce(l.quality, 0) AS y_quality, coalesce(l.toxic, 0) AS y_toxic,
         l.doc_id IS NOT NULL AS known
  FROM documents d LEFT JOIN labels l USING (doc_id)
)"""

# --- weak labels over documents ----------------------------------------------------

# Tags whose words do occur in the supplied texts.
CORPUS_TAXONOMY = Taxonomy(
    (
        Tag("english", "language", "positive", ("the of and", "is that with")),
        Tag("english_short", "language", "negative", ("to in it was this from", "on be")),
        Tag("french", "language", "negative", ("le la les des", "que qui dans une")),
        Tag("german", "language", "neutral", ("der die das", "und ist nicht ein von")),
        Tag("spanish", "language", "negative", ("el los las por con", "en que")),
    )
)

WEAK_CONFIG = WeakLabelConfig(
    taxonomy=CORPUS_TAXONOMY,
    key="doc_id",
    text="text",
    threshold={"positive": 0.85, "negative": 0.7, "neutral": 0.75},
    fallback_gate=0.3,
    lexicon_skips=(),
)


def sql_tag_score(tag: str, tokens: str = "tokens") -> str:
    parts = []
    for hypothesis in CORPUS_TAXONOMY.hypotheses_of(tag):
        words = sorted(set(hypothesis.split()))
        parts.append(f"len(list_intersect({tokens}, {sql_strings(words)})) / {len(words)}.0::DOUBLE")
    return f"greatest(0.0::DOUBLE, {', '.join(parts)})"


def weak_labels_sql() -> str:
    ids = CORPUS_TAXONOMY.ids
    polarity = CORPUS_TAXONOMY.polarity
    scored = ", ".join(f"{sql_tag_score(t)} AS s_{t}" for t in ids)
    union = " UNION ALL ".join(
        f"SELECT doc_id, '{t}' AS tag, {i} AS place, '{polarity[t]}' AS polarity, "
        f"s_{t} AS score, {WEAK_CONFIG.threshold[polarity[t]]}::DOUBLE AS needed FROM scored"
        for i, t in enumerate(ids)
    )
    return f"""
tokens AS (SELECT doc_id, list_distinct(string_split({sql_clean('text')}, ' ')) AS tokens FROM documents),
scored AS (SELECT doc_id, {scored} FROM tokens),
tag_scores AS ({union}),
record AS (
  SELECT doc_id,
         coalesce(list(tag ORDER BY place) FILTER (WHERE score >= needed), []) AS direct,
         max(score) AS max_score,
         max(score) FILTER (WHERE polarity <> 'positive') AS candidate_max,
         (list(tag ORDER BY score DESC, place) FILTER (WHERE polarity <> 'positive'))[1] AS candidate
  FROM tag_scores GROUP BY doc_id
),
weak AS (
  SELECT doc_id, max_score, candidate_max,
         len(direct) = 0 AND candidate_max >= {WEAK_CONFIG.fallback_gate} AS used_fallback,
         CASE WHEN len(direct) = 0 AND candidate_max >= {WEAK_CONFIG.fallback_gate}
              THEN [candidate] ELSE direct END AS labels,
         CASE WHEN len(direct) = 0 AND candidate_max >= {WEAK_CONFIG.fallback_gate} THEN candidate END AS choice
  FROM record
)"""


WEAK_LABELS_SQL = weak_labels_sql()


def clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").withColumn("review_clean", clean_text(F.col("text")))
