"""Weak labels over documents."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F

from tagloom.catalog.bindings import CORPUS_TAXONOMY, WEAK_CONFIG, WEAK_LABELS_SQL, sql_clean, sql_strings
from tagloom.catalog.registry import query, table
from tagloom.catalog.texts import STOPWORDS
from tagloom.functions.text import NEGATIONS, clean_text
from tagloom.operators import reports, weak_labels
from tagloom.operators.contracts import unrolled, unrolled_map
from tagloom.operators.taxonomy import V1
from tagloom.plans.labelling import (
    attach, changed_chunks, choose, committed, label_once, label_pending, labelled, pending, prepare,
)
from tagloom.sources.storage import materialise, scratch_path, write_table

SAMPLE = 100
POLARITY_VALUES = ", ".join(f"('{t}', '{p}')" for t, p in CORPUS_TAXONOMY.polarity.items())


def _hypothesis_scores(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return weak_labels.with_lexicon_scores(docs, CORPUS_TAXONOMY, "text", "scores", skips=()).drop("text")


def _labelled(spark, folder):
    return weak_labels.label(table(spark, folder, "documents"), WEAK_CONFIG)


@query(f"WITH {WEAK_LABELS_SQL} SELECT doc_id, tag, round(score, 6) AS score FROM tag_scores")
def tag_max_score(spark, folder):
    """Best hypothesis per tag, inside the row."""
    scores = weak_labels.tag_scores(F.col("scores"), CORPUS_TAXONOMY)
    rows = unrolled_map(_hypothesis_scores(spark, folder), ["doc_id"], scores, "tag", "score")
    return rows.withColumn("score", F.round("score", 6))


@query(f"WITH {WEAK_LABELS_SQL} SELECT doc_id, tag, round(score, 6) AS score FROM tag_scores")
def tag_max_score_from_rows(spark, folder):
    """The same from one row per (document, hypothesis)."""
    names = F.array(*[F.lit(h) for h in CORPUS_TAXONOMY.hypotheses])
    pairs = F.map_from_arrays(names, F.col("scores"))
    long = unrolled_map(_hypothesis_scores(spark, folder), ["doc_id"], pairs, "hypothesis", "score")
    return weak_labels.roll_up(long, CORPUS_TAXONOMY, "doc_id").withColumn("score", F.round("score", 6))


@query(
    f"""
WITH {WEAK_LABELS_SQL}
SELECT doc_id, array_to_string(labels, ',') AS labels, CAST(len(labels) AS INTEGER) AS zs_num_labels,
       round(max_score, 6) AS zs_max_score, used_fallback AS zs_used_fallback, choice AS zs_fallback_choice,
       round(CASE WHEN used_fallback THEN candidate_max END, 6) AS zs_fallback_choice_score,
       round(candidate_max, 6) AS zs_fallback_candidate_max
FROM weak"""
)
def assign_with_fallback(spark, folder):
    rows = _labelled(spark, folder)
    scores = ["zs_max_score", "zs_fallback_choice_score", "zs_fallback_candidate_max"]
    return rows.select(
        "doc_id", F.array_join("zs_labels", ",").alias("labels"), "zs_num_labels",
        "zs_used_fallback", "zs_fallback_choice", *[F.round(c, 6).alias(c) for c in scores],
    )


@query(f"WITH {WEAK_LABELS_SQL} SELECT doc_id, tag, round(score, 6) AS score FROM tag_scores")
def score_json_roundtrip(spark, folder):
    rows = weak_labels.parse_scores(_labelled(spark, folder))
    long = unrolled_map(rows, ["doc_id"], "tag_scores", "tag", "score")
    return long.withColumn("score", F.round("score", 6))


@query("SELECT event_id, CAST(props->>'k' AS DOUBLE) AS k FROM events")
def score_json_parse(spark, folder):
    rows = weak_labels.parse_scores(table(spark, folder, "events"), "props", "scores")
    return rows.select("event_id", F.col("scores")["k"].alias("k"))


@query(
    f"""
WITH {WEAK_LABELS_SQL}
SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys, round(avg(len(labels)), 9) AS avg_labels,
       median(len(labels))::DOUBLE AS median_labels,
       round(avg(CAST(used_fallback AS INTEGER)) * 100, 9) AS fallback_pct,
       round(avg(max_score), 9) AS avg_max_score,
       count(*) FILTER (WHERE len(labels) = 0) AS n_unlabelled
FROM weak"""
)
def label_run_summary(spark, folder):
    rows = reports.label_summary(_labelled(spark, folder), "doc_id")
    return rows.withColumns({c: F.round(c, 9) for c in ("avg_labels", "fallback_pct", "avg_max_score")})


@query(
    f"""
WITH {WEAK_LABELS_SQL},
names(tag, polarity) AS (VALUES {POLARITY_VALUES}),
assigned AS (SELECT doc_id, unnest(labels) AS tag FROM weak),
by_label AS (SELECT polarity, count(*) AS n, count(DISTINCT doc_id) AS docs FROM assigned JOIN names USING (tag)
             GROUP BY polarity),
by_score AS (SELECT polarity, avg(score) AS mean_score FROM tag_scores GROUP BY polarity)
SELECT p.polarity,
       round(coalesce(n, 0) / (SELECT count(*) FROM assigned)::DOUBLE, 9) AS assigned_share,
       round(coalesce(docs, 0) / (SELECT count(*) FROM weak)::DOUBLE, 9) AS row_share,
       round(mean_score, 9) AS mean_score
FROM (VALUES ('positive'), ('negative'), ('neutral'), ('unknown')) AS p(polarity)
LEFT JOIN by_label USING (polarity) LEFT JOIN by_score USING (polarity)"""
)
def polarity_diagnostics(spark, folder):
    rows = reports.polarity_report(_labelled(spark, folder), CORPUS_TAXONOMY)
    return rows.withColumns({c: F.round(c, 9) for c in ("assigned_share", "row_share", "mean_score")})


def _chunked(spark, folder, todo):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    write_table(docs.withColumn("chunk", (F.col("doc_id") % 4).cast("int")), todo, partition_by=["chunk"], balance=True)


@query("SELECT doc_id FROM documents WHERE doc_id % 4 NOT IN (1, 2)")
def resume_pending(spark, folder):
    """Keys still to be labelled when two of four chunks are committed; rows of a third without a commit do not count."""
    todo, out = scratch_path(spark, "todo"), scratch_path(spark, "labelled")
    _chunked(spark, folder, todo)
    label_pending(spark, todo, out, WEAK_CONFIG, chunks=[1, 2])
    write_table(weak_labels.label(spark.read.parquet(todo).filter("chunk = 3"), WEAK_CONFIG), f"{out}/chunk=3")
    return pending(spark, todo, out).select("doc_id")


@query(
    f"WITH {WEAK_LABELS_SQL} SELECT doc_id, array_to_string(labels, ',') AS labels FROM weak"
)
def resumable_labelling(spark, folder):
    """Label in chunks, one done by an earlier call and one left half done by another without a commit."""
    todo, out = scratch_path(spark, "todo"), scratch_path(spark, "labelled")
    _chunked(spark, folder, todo)
    label_pending(spark, todo, out, WEAK_CONFIG, chunks=[0])
    half = spark.read.parquet(todo).filter("chunk = 1 AND doc_id % 8 = 1")
    write_table(weak_labels.label(half, WEAK_CONFIG), f"{out}/chunk=1")
    label_pending(spark, todo, out, WEAK_CONFIG)
    return labelled(spark, out).select("doc_id", F.array_join("zs_labels", ",").alias("labels"))


@query(
    f"""WITH {WEAK_LABELS_SQL}
SELECT doc_id % 4 AS chunk, count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys, true AS committed FROM weak GROUP BY 1"""
)
def labelling_log(spark, folder):
    """The commit log of a labelling run against what its table holds."""
    todo, out = scratch_path(spark, "todo"), scratch_path(spark, "labelled")
    _chunked(spark, folder, todo)
    label_pending(spark, todo, out, WEAK_CONFIG)
    done = {chunk: rows for chunk, (rows, _) in committed(spark, out).items() if chunk not in changed_chunks(spark, out, "doc_id")}
    entry = F.create_map(*[F.lit(x) for pair in done.items() for x in pair])
    counted = labelled(spark, out).groupBy("chunk").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("doc_id").alias("n_keys"))
    same = F.coalesce(F.try_element_at(entry, F.col("chunk")) == F.col("n_rows"), F.lit(False))
    return counted.select(F.col("chunk").cast("bigint").alias("chunk"), "n_rows", "n_keys", same.alias("committed"))


@query(
    rf"""WITH {WEAK_LABELS_SQL}, chosen AS (
  SELECT doc_id FROM documents WHERE len(regexp_split_to_array(text, '\s+')) >= {WEAK_CONFIG.min_tokens}
  ORDER BY md5('{WEAK_CONFIG.seed}::' || doc_id), doc_id LIMIT {SAMPLE})
SELECT doc_id, lang, array_to_string(labels, ',') AS labels FROM documents JOIN chosen USING (doc_id) JOIN weak USING (doc_id)"""
)
def labelled_gold(spark, folder):
    """The whole way by paths: a written sample, labelled in one job, attached to the documents."""
    base = scratch_path(spark, "labelled-gold")
    cfg = replace(WEAK_CONFIG, sample_n=SAMPLE)
    todo = prepare(spark, f"{folder}/documents.parquet", f"{base}/todo", cfg, chunk_rows=30)
    labels = label_once(spark, todo, f"{base}/labels", cfg)
    out = attach(spark, f"{folder}/documents.parquet", labels, f"{base}/gold", "doc_id")
    return spark.read.parquet(out).select("doc_id", "lang", F.array_join("zs_labels", ",").alias("labels"))


# --- version 1 of the taxonomy over documents that end with one of its examples ---

V1_EXAMPLES = [example for tag in V1.tags for example in tag.examples]
SKIPPED = set(STOPWORDS) - set(NEGATIONS)
V1_CONFIG = weak_labels.WeakLabelConfig(key="doc_id")


def sql_v1_score(tag: str) -> str:
    parts = []
    for hypothesis in V1.hypotheses_of(tag):
        words = set(re.sub("[^a-z0-9-]", " ", hypothesis.lower()).split())
        words = sorted(words - SKIPPED or words)
        parts.append(f"len(list_intersect(w, {sql_strings(words)})) / {len(words)}.0::DOUBLE")
    return f"greatest({', '.join(parts)})"


V1_ROWS = ", ".join(
    f"({k}, '{t.id}', '{t.label}', '{t.group}', {len(t.examples)}, {V1_CONFIG.threshold_of(t.id)}::DOUBLE)" for k, t in enumerate(V1.tags)
)


@query(
    f"""WITH words AS MATERIALIZED (
  SELECT doc_id, list_distinct(string_split({sql_clean(f"text || ' ' || {sql_strings(V1_EXAMPLES)}[doc_id % {len(V1_EXAMPLES)} + 1]")}, ' ')) AS w FROM documents),
scores AS MATERIALIZED (SELECT doc_id, [{', '.join(sql_v1_score(t) for t in V1.ids)}] AS scores FROM words),
tags(place, tag, label, tag_group, n_examples, needed) AS (VALUES {V1_ROWS})
SELECT doc_id, tag, label, tag_group, n_examples, round(scores[place + 1], 6) AS score FROM scores, tags WHERE scores[place + 1] >= needed"""
)
def taxonomy_v1_labels(spark, folder):
    """Labels of version 1 with their names and groups; one of its examples stands behind each document."""
    example = F.get(F.array(*[F.lit(e) for e in V1_EXAMPLES]), (F.col("doc_id") % len(V1_EXAMPLES)).cast("int"))
    docs = table(spark, folder, "documents").select("doc_id", clean_text(F.concat("text", F.lit(" "), example)).alias("review_clean"))
    scored = weak_labels.parse_scores(weak_labels.label(docs, V1_CONFIG))
    rows = unrolled(scored, ["doc_id", "tag_scores"], "zs_labels", "tag")
    groups = V1.frame(spark).select("tag", "tag_group").distinct()
    named = V1.described(spark).select("tag", "label", F.size("examples").alias("n_examples")).join(groups, "tag")
    score = F.round(F.element_at("tag_scores", F.col("tag")), 6).alias("score")
    return rows.join(F.broadcast(named), "tag").select("doc_id", "tag", "label", "tag_group", "n_examples", score)


@query("SELECT lang, count(*) AS n_rows, count(DISTINCT source) AS n_keys, true AS within FROM documents GROUP BY lang")
def distinct_keys_sketched(spark, folder):
    """Distinct keys of merged sketches beside the exact count: within the stated error."""
    docs = table(spark, folder, "documents").select("lang", "source", (F.col("doc_id") % 7).alias("day"))
    stored = materialise(reports.distinct_sketches(docs, "source", ["lang", "day"]), "sketches")
    exact = docs.groupBy("lang").agg(F.count_distinct("source").alias("exact"))
    merged = reports.merged_distinct(stored, ["lang"]).join(exact, "lang")
    return merged.select("lang", "n_rows", F.col("exact").alias("n_keys"), (F.abs(F.col("n_keys") - F.col("exact")) <= F.col("error")).alias("within"))


@query(
    rf"""
SELECT doc_id, token_count FROM (
  SELECT doc_id, CAST(len(regexp_split_to_array(text, '\s+')) AS INTEGER) AS token_count FROM documents)
WHERE token_count >= {WEAK_CONFIG.min_tokens}
ORDER BY md5('{WEAK_CONFIG.seed}::' || doc_id), doc_id LIMIT {SAMPLE}"""
)
def labelling_input(spark, folder):
    """The sample a labelling run would be given."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return choose(docs, replace(WEAK_CONFIG, sample_n=SAMPLE)).select("doc_id", "token_count")


def prompt_words(hypothesis: str) -> list[str]:
    prompt = weak_labels.HYPOTHESIS_TEMPLATE.format(hypothesis)
    return sorted(set(prompt.lower().rstrip(".").split(" ")))


def sql_prompt_score(tag: str) -> str:
    parts = [
        f"len(list_intersect(w, {sql_strings(words)})) / {len(words)}.0::DOUBLE"
        for words in map(prompt_words, CORPUS_TAXONOMY.hypotheses_of(tag))
    ]
    return f"SELECT doc_id, '{tag}' AS tag, round(greatest({', '.join(parts)}), 6) AS score FROM words"


@query(
    "WITH words AS (SELECT doc_id, list_distinct(string_split(lower(text), ' ')) AS w FROM documents) "
    + " UNION ALL ".join(sql_prompt_score(t) for t in CORPUS_TAXONOMY.ids)
)
def plugged_in_scorer(spark, folder):
    """A scorer loaded once per task: the share of a prompt's words in the text."""

    def load():
        def score(texts, prompts):
            words = [set(p.lower().rstrip(".").split(" ")) for p in prompts]
            return [[len(w & set(t.lower().split(" "))) / len(w) for w in words] for t in texts]

        return score

    rows = weak_labels.parse_scores(weak_labels.label(table(spark, folder, "documents"), WEAK_CONFIG, load))
    long = unrolled_map(rows, ["doc_id"], "tag_scores", "tag", "score")
    return long.withColumn("score", F.round("score", 6))
