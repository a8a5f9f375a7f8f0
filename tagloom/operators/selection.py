"""Choosing rows: exact-size samples, candidates, exclusions, unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.keys import SEED_SEPARATOR
from tagloom.functions.text import contains_any_word
from tagloom.operators.contracts import free_name
from tagloom.operators.joins import join_to_one

# Words that mark a review as risky for each under-labelled tag.
RISK_WORDS = {
    "too_spicy": ("spicy", "hot", "cayenne", "chili", "burn", "heat", "kick"),
    "too_salty": ("salty", "salt", "sodium", "brine"),
    "too_acidic": ("acidic", "vinegar", "lemon", "lime", "tart", "sour", "tangy"),
    "too_sweet": ("sweet", "sugar", "syrup", "cloying", "honey"),
    "mushy_soggy": ("mushy", "soggy", "wet", "limp", "texture"),
    "bland_lacks_flavor": ("bland", "tasteless", "flavorless", "boring", "plain"),
}
# Leading hex digits of the order hash used to find the cut; 16**4 buckets.
CUT_DIGITS = 4


def sample_cut(df: DataFrame, n: int, key: str | Sequence[str], *, seed: int = 42) -> Column:
    """Condition that the ``n`` rows of ``df`` with the smallest seeded hash of ``key`` meet (all, if fewer).

    Which rows those are depends on the data alone, not on its layout. A
    histogram of hash buckets (at most 65,536 rows) finds the bucket that holds
    the n-th row; only that bucket's hashes are ranked. Both are counted here,
    when the condition is made. It reads the key alone, so it can stand before
    costlier filters, and the sample never meets in one task. Keys must be
    unique where exactly ``n`` rows are wanted: rows that tie with the last one
    are all in.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = F.md5(F.concat_ws(SEED_SEPARATOR, F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    bucket = F.conv(F.substring(order, 1, CUT_DIGITS), 16, 10).cast("int")
    running = F.sum("rows").over(Window.orderBy("bucket"))
    left = F.lit(n) - F.col("running") + F.col("rows")
    cut = (
        df.groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("bucket", "rows", running.alias("running"))
        .filter(F.col("running") >= n)
        .agg(F.min_by(F.struct("bucket", left.alias("left")), "bucket").alias("cut"))
        .first()["cut"]
    )
    if cut is None:
        return F.lit(True)
    hashes = df.filter(bucket == cut["bucket"]).select(order.alias("order"))
    last = hashes.orderBy("order").limit(cut["left"]).agg(F.max("order")).first()[0] if cut["left"] else ""
    return order <= last if last else bucket < cut["bucket"]


def sample_exactly(df: DataFrame, n: int, key: str | Sequence[str], *, seed: int = 42) -> DataFrame:
    """The rows of ``sample_cut``."""
    return df.filter(sample_cut(df, n, key, seed=seed))


def conflict_candidates(
    df: DataFrame,
    words: Sequence[str] | None = None,
    *,
    rating: str = "rating",
    text: str = "review_clean",
    rating_from: float = 4.0,
) -> DataFrame:
    """Well-rated rows whose text still holds a risk word."""
    if words is None:
        words = [w for group in RISK_WORDS.values() for w in group]
    return df.filter((F.col(rating) >= rating_from) & contains_any_word(F.col(text), words))


def without_keys(df: DataFrame, done: DataFrame, key: str = "review_key") -> DataFrame:
    """Rows whose key is not in ``done``; rows without a key stay. A frequent key of the rows is no one task's work."""
    return join_to_one(df, done.select(key).distinct(), key, "left_anti")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def one_per_key(
    frames: Sequence[DataFrame], key: str = "review_key", prefer: Sequence[str] = ()
) -> DataFrame:
    """Union by name, one row per key. A later frame wins; within a frame the
    greatest ``prefer`` columns win. Repeats collapse before the shuffle."""
    first, *rest = frames
    number = free_name(first, "frame")
    stacked = first.withColumn(number, F.lit(0))
    for position, frame in enumerate(rest, start=1):
        stacked = stacked.unionByName(frame.withColumn(number, F.lit(position)))
    fields = [c for c in first.columns if c != key]
    row = free_name(first, "row")
    kept = F.max_by(F.struct(*fields), F.struct(number, *prefer)).alias(row)
    return stacked.groupBy(key).agg(kept).select(key, f"{row}.*").select(*first.columns)


def top_groups(df: DataFrame, by: Sequence[str], rating: str, liked: str, n: int = 10) -> DataFrame:
    """Most reviewed groups: count, mean rating (3 places), liked count."""
    stats = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.round(F.avg(rating), 3).alias("avg_rating"),
        F.sum(liked).alias("n_liked"),
    )
    return stats.orderBy(F.desc("n_reviews"), F.desc("avg_rating"), *by).limit(n)


def examples_with_tag(df: DataFrame, tag: str, text: str, key: str, n: int = 5, prefix: str = "pred_") -> DataFrame:
    """A few texts carrying a tag, for reading by eye; smallest keys first."""
    return df.filter(F.col(f"{prefix}{tag}") == 1).select(key, text).orderBy(key).limit(n)
