"""Weak labels: score hypotheses, roll up to tags, assign by polarity threshold.

All of it happens inside the row, so labelling adds no shuffle: a row carries
one score array in hypothesis order, then one map from tag to score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import clean_words, stopword_list
from tagloom.operators.contracts import free_name, require_columns
from tagloom.operators.taxonomy import V1, Taxonomy

# Fixed value: the sentence a classifier is asked to judge, per hypothesis.
HYPOTHESIS_TEMPLATE = "This review says the recipe was {}."

# Scores a batch of texts: (texts, hypotheses) -> one row of scores per text.
Scorer = Callable[[Sequence[str], Sequence[str]], Sequence[Sequence[float]]]


@dataclass(frozen=True)
class WeakLabelConfig:
    taxonomy: Taxonomy = V1
    key: str = "review_key"
    text: str = "review_clean"
    min_tokens: int = 15
    sample_n: int = 10_000
    seed: int = 42
    # Score needed per polarity, and the gate of the fallback.
    threshold: dict[str, float] = field(
        default_factory=lambda: {"positive": 0.85, "negative": 0.40, "neutral": 0.55}
    )
    fallback_gate: float = 0.55
    fallback_top_k: int = 1
    fallback_allow_positive: bool = False
    # Words the lexicon skips; None means Spark's stopwords without negations.
    lexicon_skips: tuple[str, ...] | None = None

    def threshold_of(self, tag: str) -> float:
        polarity = self.taxonomy.polarity.get(tag, "neutral")
        return self.threshold.get(polarity, self.fallback_gate)


def with_lexicon_scores(
    df: DataFrame, taxonomy: Taxonomy = V1, text: str = "review_clean", out: str = "hypothesis_scores",
    *, skips: Sequence[str] | None = None,
) -> DataFrame:
    """Share of each hypothesis' content words found in the text, as ``array<double>``.

    A deterministic stand-in for a trained model. The text is intersected once
    with all hypothesis words; what is left is at most as long as that list, and
    every hypothesis is then compared with those few words only.
    """
    skipped = set(stopword_list() if skips is None else skips)
    words_of = []
    for hypothesis in taxonomy.hypotheses:
        words = set(_clean_words(hypothesis))
        words_of.append(sorted(words - skipped or words))
    vocabulary = sorted({w for words in words_of for w in words})
    hits = F.array_intersect(clean_words(F.col(text)), _strings(vocabulary))
    name = free_name(df, "hits")
    found = df.withColumn(name, hits)
    shares = [F.size(F.array_intersect(F.col(name), _strings(w))) / len(w) for w in words_of]
    return found.withColumn(out, F.array(*shares)).drop(name)


def _clean_words(hypothesis: str) -> list[str]:
    return "".join(c if c.isascii() and (c.isalnum() or c == "-") else " " for c in hypothesis.lower()).split()


def _strings(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def with_model_scores(
    df: DataFrame, load: Callable[[], Scorer], taxonomy: Taxonomy = V1,
    text: str = "review_clean", out: str = "hypothesis_scores",
) -> DataFrame:
    """Plug in a classifier: ``load`` runs once per task and returns the scorer.

    Only the text column travels to Python, in Arrow batches.
    """
    prompts = [HYPOTHESIS_TEMPLATE.format(h) for h in taxonomy.hypotheses]

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load()
        for texts in batches:
            rows = scorer(texts.fillna("").tolist(), prompts)
            yield pd.Series([[float(s) for s in row] for row in rows], index=texts.index)

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(out, F.pandas_udf(score, "array<double>")(F.col(text)))


def tag_scores(hypothesis_scores: Column, taxonomy: Taxonomy = V1) -> Column:
    """Best hypothesis per tag, floor 0, as ``map<string,double>`` in tag order."""
    columns, position = [], 0
    for tag in taxonomy.tags:
        own = [F.get(hypothesis_scores, F.lit(position + i)) for i in range(len(tag.hypotheses))]
        columns.append(F.greatest(F.lit(0.0), *own))
        position += len(own)
    return F.map_from_arrays(_strings(taxonomy.ids), F.array(*columns))


def roll_up(scores_long: DataFrame, taxonomy: Taxonomy = V1, key: str = "review_key") -> DataFrame:
    """(key, hypothesis, score) rows from elsewhere to (key, tag, score).

    Unknown hypotheses are ignored. The taxonomy is a fixed handful of rows.
    """
    names = taxonomy.frame(scores_long.sparkSession).select("hypothesis", "tag")
    best = F.greatest(F.max("score"), F.lit(0.0)).alias("score")
    return scores_long.join(F.broadcast(names), "hypothesis").groupBy(key, "tag").agg(best)


def assign(df: DataFrame, cfg: WeakLabelConfig = WeakLabelConfig(), scores: str = "tag_scores") -> DataFrame:
    """Turn a tag-score map into the label record.

    A tag is assigned when its score reaches its polarity's threshold. When none
    does and the best allowed candidate reaches the gate, the top candidates are
    taken instead; equal scores keep taxonomy order.
    """
    require_columns(df, [cfg.key, scores], "assign")
    ids = cfg.taxonomy.ids
    score_of = {t: F.coalesce(F.col(scores)[t], F.lit(0.0)) for t in ids}
    polarity = cfg.taxonomy.polarity
    allowed = [t for t in ids if cfg.fallback_allow_positive or polarity[t] != "positive"]

    direct = F.array_compact(
        F.array(*[F.when(score_of[t] >= cfg.threshold_of(t), F.lit(t)) for t in ids])
    )
    best_allowed = F.greatest(F.lit(0.0), F.lit(0.0), *[score_of[t] for t in allowed])
    ranked = F.array_sort(
        F.array(
            *[
                F.struct((-score_of[t]).alias("order"), F.lit(i).alias("place"), F.lit(t).alias("tag"))
                for i, t in enumerate(allowed)
            ]
        )
    ) if allowed else F.array().cast("array<struct<order:double,place:int,tag:string>>")
    top = F.slice(ranked, 1, max(cfg.fallback_top_k, 0))

    staged = df.select(
        F.col(cfg.key),
        F.to_json(F.col(scores)).alias("zs_scores_json"),
        direct.alias("_direct"),
        F.greatest(F.lit(0.0), F.lit(0.0), *score_of.values()).alias("zs_max_score"),
        best_allowed.alias("zs_fallback_candidate_max"),
        top.alias("_top"),
    )
    used = (
        (F.size("_direct") == 0)
        & (F.size("_top") > 0)
        & (F.col("zs_fallback_candidate_max") >= cfg.fallback_gate)
    )
    chosen = staged.withColumn("zs_used_fallback", used).withColumn(
        "zs_labels", F.when(F.col("zs_used_fallback"), F.col("_top.tag")).otherwise(F.col("_direct"))
    )
    first = F.get("_top", F.lit(0))
    return chosen.select(
        cfg.key,
        "zs_labels",
        "zs_scores_json",
        F.size("zs_labels").alias("zs_num_labels"),
        "zs_max_score",
        "zs_used_fallback",
        F.when(F.col("zs_used_fallback"), first["tag"]).alias("zs_fallback_choice"),
        F.when(F.col("zs_used_fallback"), -first["order"]).alias("zs_fallback_choice_score"),
        "zs_fallback_candidate_max",
    )


def label(
    df: DataFrame,
    cfg: WeakLabelConfig = WeakLabelConfig(),
    load: Callable[[], Scorer] | None = None,
) -> DataFrame:
    """Score and assign in one pass; without a scorer to load, by the lexicon."""
    rows = df.select(cfg.key, cfg.text)
    if load is None:
        scored = with_lexicon_scores(rows, cfg.taxonomy, cfg.text, skips=cfg.lexicon_skips)
    else:
        scored = with_model_scores(rows, load, cfg.taxonomy, cfg.text)
    rolled = scored.select(cfg.key, tag_scores(F.col("hypothesis_scores"), cfg.taxonomy).alias("tag_scores"))
    return assign(rolled, cfg)


def parse_scores(df: DataFrame, source: str = "zs_scores_json", out: str = "tag_scores") -> DataFrame:
    """JSON score text back to a map."""
    return df.withColumn(out, F.from_json(F.col(source), "map<string,double>"))
