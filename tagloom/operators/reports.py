"""Data-quality, prevalence, co-occurrence and labelling reports.

Each report is one aggregation (plus reshaping of its few result rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import char_length, is_blank
from tagloom.operators.contracts import unrolled
from tagloom.operators.taxonomy import V1, Taxonomy

ROWS = "*"


def _long(one_row: DataFrame, name: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    values = [f"`{c}`" for c in one_row.columns if c not in keys]
    return one_row.unpivot(list(keys), values, name, value)


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(ROWS).alias("n"))


def label_prevalence(df: DataFrame, labels: Sequence[str], prefix: str = "y_") -> DataFrame:
    """(label, prevalence): mean of each 0/1 column, 0 for an empty table."""
    means = [F.coalesce(F.avg(F.col(f"{prefix}{t}").cast("double")), F.lit(0.0)).alias(t) for t in labels]
    return _long(df.agg(*means), "label", "prevalence")


def label_prevalence_by(df: DataFrame, key: str, labels: Sequence[str], prefix: str = "y_") -> DataFrame:
    """(key, label, prevalence), e.g. per split."""
    means = [F.coalesce(F.avg(F.col(f"{prefix}{t}").cast("double")), F.lit(0.0)).alias(t) for t in labels]
    return _long(df.groupBy(key).agg(*means), "label", "prevalence", [key])


def distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, n, pct): rows per value and their share of all rows."""
    counts = counts_by(df, column)
    return counts.withColumn("pct", F.col("n") * 100.0 / counts.agg(F.sum("n")).scalar())


def share_where(df: DataFrame, condition: Column, out: str = "pct") -> DataFrame:
    """Percentage of rows meeting a condition."""
    return df.agg((F.avg(F.coalesce(condition, F.lit(False)).cast("double")) * 100.0).alias(out))


def tag_totals(df: DataFrame, tags: Sequence[str], prefix: str = "pred_") -> DataFrame:
    """(tag, hits, pct), most frequent first. One pass over the 0/1 columns."""
    sums = [F.coalesce(F.sum(F.col(f"{prefix}{t}").cast("long")), F.lit(0)).alias(t) for t in tags]
    wide = df.agg(F.count(ROWS).alias("_rows"), *sums)
    hits = _long(wide, "tag", "hits", ["_rows"])
    return hits.select(
        "tag", "hits", F.coalesce(F.try_divide(F.col("hits") * 100.0, F.col("_rows")), F.lit(0.0)).alias("pct")
    ).orderBy(F.desc("hits"), "tag")


def tag_density(df: DataFrame, total: str = "total_tags") -> DataFrame:
    return counts_by(df, total).orderBy(total)


def mean_tags(df: DataFrame, total: str = "total_tags") -> DataFrame:
    return df.agg(F.avg(total).alias("avg_tags"))


def co_occurrence(df: DataFrame, tag_list: str = "tag_list") -> DataFrame:
    """(tag_a, tag_b, n): rows holding both tags, full symmetric matrix.

    Rows collapse to distinct tag sets first. Only those few sets, with their
    counts, are unrolled into pairs.
    """
    combos = (
        df.select(F.array_sort(F.array_distinct(F.col(tag_list))).alias("tags"))
        .groupBy("tags")
        .agg(F.count(ROWS).alias("n"))
    )
    pairs = unrolled(unrolled(combos, ["tags", "n"], "tags", "tag_a"), ["tag_a", "n"], "tags", "tag_b")
    return pairs.groupBy("tag_a", "tag_b").agg(F.sum("n").alias("n"))


def entity_stats(df: DataFrame, by: Sequence[str], rating: str = "rating", liked: str = "liked") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(ROWS).alias("n_reviews"),
        F.round(F.avg(rating), 3).alias("avg_rating"),
        F.sum(liked).alias("n_liked"),
    )


def length_summary(df: DataFrame, text: str) -> DataFrame:
    length = char_length(F.col(text))
    return df.agg(
        F.min(length).alias("min_len"), F.round(F.avg(length), 2).alias("avg_len"), F.max(length).alias("max_len")
    )


def percentiles(df: DataFrame, value: Column, at: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """(p, value) from a mergeable sketch: bounded state at any row count."""
    sketched = df.agg(F.percentile_approx(value, list(at), accuracy).alias("found"))
    points = F.arrays_zip(F.array(*[F.lit(float(p)) for p in at]).alias("p"), F.col("found").alias("value"))
    return sketched.select(F.inline(points))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls)."""
    return _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "column", "nulls")


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, blanks): values that are empty after trimming."""
    return _long(df.agg(*[F.count_if(is_blank(F.col(c))).alias(c) for c in columns]), "column", "blanks")


def label_report(df: DataFrame, labels: str = "zs_labels") -> DataFrame:
    """(tag, n, pct): rows per assigned tag and their share of all rows.

    The row without a tag name counts the rows that have no label at all.
    """
    tags = df.select(F.posexplode_outer(F.array_distinct(F.col(labels))).alias("place", "tag"))
    first = F.col("place").isNull() | (F.col("place") == 0)  # one mark for each row, so the counts hold the total
    counted = tags.groupBy("tag").agg(F.count(ROWS).alias("n"), F.count_if(first).alias("rows"))
    return counted.select("tag", "n", (F.col("n") * 100.0 / counted.agg(F.sum("rows")).scalar()).alias("pct"))


def distinct_sketches(df: DataFrame, key: str, by: Sequence[str] = (), *, precision: int = 14) -> DataFrame:
    """(by..., n_rows, sketch): a mergeable sketch of the distinct keys of each group.

    Sketches of parts, of days say, can be stored and merged, so a distinct count
    over many of them needs no pass over their rows. Null keys are left out.
    """
    name = F.when(F.col(key).isNotNull(), F.xxhash64(key))
    return df.groupBy(*by).agg(F.count(ROWS).alias("n_rows"), F.hll_sketch_agg(name, precision).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Sequence[str] = (), *, precision: int = 14, deviations: float = 3.0) -> DataFrame:
    """(by..., n_rows, n_keys, error): distinct keys of merged sketches, and how far the count may be off.

    ``error`` is ``deviations`` standard errors of 1.04 / sqrt(2^precision) of the count.
    """
    counted = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_keys")
    )
    return counted.withColumn("error", F.ceil(F.col("n_keys") * (deviations * 1.04 / 2 ** (precision / 2))))


def label_summary(df: DataFrame, key: str = "review_key") -> DataFrame:
    """One row: rows, distinct keys, label averages, fallback and zero-label shares.

    The median is over label counts, which a taxonomy bounds to a few values.
    """
    return df.agg(
        F.count(ROWS).alias("n_rows"),
        F.count_distinct(F.col(key)).alias("n_keys"),
        F.avg("zs_num_labels").alias("avg_labels"),
        F.median("zs_num_labels").alias("median_labels"),
        (F.avg(F.col("zs_used_fallback").cast("int")) * 100.0).alias("fallback_pct"),
        F.avg("zs_max_score").alias("avg_max_score"),
        F.count_if(F.col("zs_num_labels") == 0).alias("n_unlabelled"),
    )


def polarity_report(
    df: DataFrame, taxonomy: Taxonomy = V1, labels: str = "zs_labels", scores: str = "zs_scores_json"
) -> DataFrame:
    """(polarity, assigned_share, row_share, mean_score) for each polarity.

    ``assigned_share`` is over assigned labels, ``row_share`` the share of rows
    with at least one label of the polarity, ``mean_score`` over all tag scores.
    One pass: polarity membership is a fixed list, so each row adds a few
    numbers and nothing is exploded or joined. Tags outside the taxonomy are
    ``unknown``.
    """
    polarities = ("positive", "negative", "neutral")
    members = {p: [t for t in taxonomy.ids if taxonomy.polarity[t] == p] for p in polarities}
    known = [t for t in taxonomy.ids]
    score_map = F.from_json(F.col(scores), "map<string,double>")
    rows = df.select(
        F.coalesce(F.col(labels), F.array().cast("array<string>")).alias("labels"),
        F.map_entries(score_map).alias("scores"),
    )

    def of(tag: Column, polarity: str) -> Column:
        if polarity == "unknown":
            return ~tag.isin(known)
        return tag.isin(members[polarity]) if members[polarity] else F.lit(False)

    parts = []
    for p in (*polarities, "unknown"):
        own_labels = F.size(F.filter("labels", lambda t: of(t, p)))
        own_scores = F.transform(F.filter("scores", lambda e: of(e["key"], p)), lambda e: e["value"])
        parts += [
            F.sum(own_labels).alias(f"labels_{p}"),
            F.avg((own_labels > 0).cast("double")).alias(f"rows_{p}"),
            F.sum(F.aggregate(own_scores, F.lit(0.0), lambda a, s: a + s)).alias(f"score_{p}"),
            F.sum(F.size(own_scores)).alias(f"scores_{p}"),
        ]
    totals = rows.agg(F.sum(F.size("labels")).alias("assigned"), *parts)
    report = F.array(
        *[
            F.struct(
                F.lit(p).alias("polarity"),
                F.coalesce(F.try_divide(F.col(f"labels_{p}"), F.col("assigned")), F.lit(0.0)).alias("assigned_share"),
                F.coalesce(F.col(f"rows_{p}"), F.lit(0.0)).alias("row_share"),
                F.try_divide(F.col(f"score_{p}"), F.col(f"scores_{p}")).alias("mean_score"),
            )
            for p in (*polarities, "unknown")
        ]
    )
    return totals.select(F.inline(report))
