"""List literals and tolerant casts. Unreadable input is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.text import clean_if_given, clean_text

# The order of the seven numbers in a nutrition list.
NUTRITION_FIELDS = (
    "calories", "fat", "sugar", "sodium", "protein", "saturated_fat", "carbs",
)


def string_list(literal: Column) -> Column:
    """``"['salt', \\"baker's yeast\\"]"`` to ``array<string>``.

    Spark's JSON reader takes single quotes as they are, so apostrophes inside
    double-quoted items survive.
    """
    return F.from_json(literal, "array<string>")


def number_list(literal: Column) -> Column:
    return F.from_json(literal, "array<double>")


def nutrition_columns(literal: Column) -> list[Column]:
    """Seven named doubles; a short or missing list leaves trailing nulls."""
    numbers = number_list(literal)
    return [F.get(numbers, F.lit(i)).alias(f) for i, f in enumerate(NUTRITION_FIELDS)]


def as_identifier(value: Column) -> Column:
    return value.cast("string")


def as_number(value: Column) -> Column:
    return value.try_cast("double")


def as_day(value: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(value, fmt)


def as_instant(value: Column) -> Column:
    return F.try_to_timestamp(value)


def ingredient_terms(literal: Column) -> Column:
    """One underscore-joined term per ingredient, space separated.

    Here and below an unreadable list gives null, so that later not-null checks
    see it.
    """
    terms = F.transform(
        string_list(literal), lambda item: F.replace(clean_text(item), F.lit(" "), F.lit("_"))
    )
    return F.array_join(terms, " ")


def step_text(literal: Column) -> Column:
    return clean_if_given(F.array_join(string_list(literal), " "))


def tag_terms(literal: Column) -> Column:
    return F.array_join(F.transform(string_list(literal), lambda item: clean_text(item)), " ")
