"""Raw CSV layouts and table column orders, as DDL and tuples."""

RECIPES_CSV = (
    "name string, id long, minutes long, contributor_id long, submitted string, "
    "tags string, nutrition string, n_steps long, steps string, description string, "
    "ingredients string, n_ingredients long"
)
INTERACTIONS_CSV = "user_id long, recipe_id long, date string, rating long, review string"
CORRUPT_COLUMN = "_corrupt_record"

REVIEW_FIELDS = ("user_id", "recipe_id", "date", "rating", "review_clean")
RECIPE_TEXT_FIELDS = ("ingredients_clean", "steps_clean", "tags_clean", "description_clean")
RECIPE_NUMBER_FIELDS = (
    "minutes", "n_steps", "n_ingredients",
    "calories", "fat", "sugar", "sodium", "protein", "saturated_fat", "carbs",
)

GOLD_REVIEWS = ("review_key", "user_id", "recipe_id", "date", "rating", "liked", "review_clean")
GOLD_RECIPES = ("recipe_id", "name", *RECIPE_TEXT_FIELDS, *RECIPE_NUMBER_FIELDS)
GOLD_WIDE = (
    "recipe_id", "name", "user_id", "date", "rating", "liked", "review_key", "review_clean",
    *RECIPE_TEXT_FIELDS, *RECIPE_NUMBER_FIELDS,
)
VECTOR_VIEW = (
    "recipe_id", "name", "rating", "liked", "date", "review_clean",
    *RECIPE_TEXT_FIELDS, *RECIPE_NUMBER_FIELDS,
)
RATINGS_VIEW = ("user_id", "recipe_id", "rating")
LABELLED_REQUIRED = ("review_key", "recipe_id", "review_clean", "zs_labels")
