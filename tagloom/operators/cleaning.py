"""Bronze to silver: coerce types, clean text, drop unusable rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import parsing as parse
from tagloom.functions.text import clean_text, clean_token_count, raw_token_count
from tagloom.operators.contracts import not_null

# Token bounds of a review, and the rating that means "not given".
MIN_TOKENS = 15
MAX_TOKENS = 120
MISSING_RATING = 0.0


def coerce_recipes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            **{c: parse.as_identifier(F.col(c)) for c in ("id", "contributor_id")},
            **{c: parse.as_number(F.col(c)) for c in ("minutes", "n_steps", "n_ingredients")},
            "submitted": parse.as_instant(F.col("submitted")),
        }
    )


def clean_recipes(df: DataFrame) -> DataFrame:
    """Typed recipes with cleaned text columns and seven nutrition numbers.

    A cleaned or nutrition column that is already there keeps its values.
    """
    derived = {
        "ingredients_clean": parse.ingredient_terms(F.col("ingredients")),
        "steps_clean": parse.step_text(F.col("steps")),
        "tags_clean": parse.tag_terms(F.col("tags")),
        "description_clean": clean_text(F.col("description")),
        **dict(zip(parse.NUTRITION_FIELDS, parse.nutrition_columns(F.col("nutrition")))),
    }
    return coerce_recipes(df).withColumns(
        {
            name: F.coalesce(F.col(name), value) if name in df.columns else value
            for name, value in derived.items()
        }
    )


def coerce_interactions(df: DataFrame) -> DataFrame:
    """Typed ids, rating and date; rows without user, recipe or a real rating go."""
    typed = df.withColumns(
        {
            "user_id": parse.as_identifier(F.col("user_id")),
            "recipe_id": parse.as_identifier(F.col("recipe_id")),
            "rating": parse.as_number(F.col("rating")),
            "date": parse.as_day(F.col("date").cast("string")),
        }
    )
    return not_null(typed, ("user_id", "recipe_id", "rating")).filter(F.col("rating") != MISSING_RATING)


def within_token_band(
    df: DataFrame, text: str = "review", low: int = MIN_TOKENS, high: int = MAX_TOKENS
) -> DataFrame:
    """Rows whose raw token count lies in [low, high]; adds ``token_count``."""
    counted = df.withColumn("token_count", raw_token_count(F.col(text)))
    return counted.filter(F.col("token_count").between(low, high))


def with_clean_review(df: DataFrame, text: str = "review", out: str = "review_clean") -> DataFrame:
    """Cleaned text; an input without the text column gets ``''``."""
    return df.withColumn(out, clean_text(F.col(text)) if text in df.columns else F.lit(""))


def clean_interactions(df: DataFrame, low: int = MIN_TOKENS, high: int = MAX_TOKENS) -> DataFrame:
    # Typed filters first: they are cheap and spare the regex pass on dropped rows.
    return with_clean_review(within_token_band(coerce_interactions(df), low=low, high=high))


def with_token_count(df: DataFrame, text: str = "review_clean", out: str = "token_count") -> DataFrame:
    return df.withColumn(out, clean_token_count(F.col(text)))


def with_min_tokens(df: DataFrame, minimum: int = MIN_TOKENS, text: str = "review_clean") -> DataFrame:
    return with_token_count(df, text).filter(F.col("token_count") >= minimum)
