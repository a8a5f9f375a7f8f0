"""Silver to gold: keyed review table, recipe dimension, wide join, views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.keys import row_key
from tagloom.operators.contracts import in_order, not_null, require_columns, without_columns
from tagloom.operators.joins import join_to_one
from tagloom.sources import schemas

# Fixed value: the rating from which a review counts as liked.
LIKED_FROM = 4.0


def with_liked(df: DataFrame, rating: str = "rating", out: str = "liked") -> DataFrame:
    return df.withColumn(out, (F.col(rating) >= LIKED_FROM).cast("int"))


def with_review_key(
    df: DataFrame,
    parts: tuple[str, ...] = ("user_id", "recipe_id", "date", "review_clean"),
    out: str = "review_key",
) -> DataFrame:
    require_columns(df, parts, "review key")
    return df.withColumn(out, row_key(*[F.col(p) for p in parts]))


def gold_reviews(interactions: DataFrame) -> DataFrame:
    """Complete, distinct reviews with a key and the ``liked`` target.

    The columns kept are the columns compared, so duplicates collapse on the
    map side before anything is shuffled, however often one review repeats.
    """
    require_columns(interactions, schemas.REVIEW_FIELDS, "interactions")
    distinct = not_null(interactions.select(*schemas.REVIEW_FIELDS), schemas.REVIEW_FIELDS).distinct()
    return in_order(with_review_key(with_liked(distinct)), schemas.GOLD_REVIEWS, strict=True)


def gold_recipes(recipes: DataFrame) -> DataFrame:
    """Recipe dimension: only rows with every field present."""
    require_columns(recipes, ("id", *schemas.GOLD_RECIPES[1:]), "recipes")
    renamed = recipes.withColumnRenamed("id", "recipe_id").select(*schemas.GOLD_RECIPES)
    return not_null(renamed, schemas.GOLD_RECIPES)


def gold_wide(reviews: DataFrame, recipes: DataFrame, key: str = "recipe_id") -> DataFrame:
    """Reviews with their recipe's fields; a much-reviewed recipe is split."""
    require_columns(reviews, [key], "reviews")
    require_columns(recipes, [key], "recipes")
    return in_order(join_to_one(reviews, recipes, key), schemas.GOLD_WIDE)


def vector_view(wide: DataFrame) -> DataFrame:
    """Modelling view: its columns in their order, those that are there; keys, raw text and persons go."""
    return wide.select(*[c for c in schemas.VECTOR_VIEW if c in wide.columns])


def ratings_view(wide: DataFrame) -> DataFrame:
    """(user, recipe, rating) triples for collaborative use."""
    require_columns(wide, schemas.RATINGS_VIEW, "ratings view")
    return wide.select(*schemas.RATINGS_VIEW)


def attach_by_key(base: DataFrame, other: DataFrame, key: str = "review_key") -> DataFrame:
    """Inner join to a table with one row per key, e.g. labels onto reviews."""
    require_columns(base, [key], "base")
    require_columns(other, [key], "labels")
    return join_to_one(base, other, key)
