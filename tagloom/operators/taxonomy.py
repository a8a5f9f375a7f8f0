"""The tag taxonomy: which tags exist, how they are phrased, and which clash."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tag:
    id: str
    group: str
    polarity: str
    hypotheses: tuple[str, ...]
    # For people and reports; the words of the id unless given.
    label: str = ""
    description: str = ""
    examples: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.label:
            object.__setattr__(self, "label", self.id.replace("_", " ").capitalize())


@dataclass(frozen=True)
class Taxonomy:
    """An ordered set of tags. Order decides ties, so it is part of the data."""

    tags: tuple[Tag, ...]

    def __post_init__(self) -> None:
        silent = [t.id for t in self.tags if not t.hypotheses]
        if silent:
            raise ValueError(f"Tags without a hypothesis: {silent}")

    @property
    def ids(self) -> list[str]:
        return [t.id for t in self.tags]

    @property
    def hypotheses(self) -> list[str]:
        return [h for t in self.tags for h in t.hypotheses]

    @property
    def polarity(self) -> dict[str, str]:
        return {t.id: t.polarity for t in self.tags}

    @property
    def groups(self) -> dict[str, list[str]]:
        members: dict[str, list[str]] = {}
        for t in self.tags:
            members.setdefault(t.group, []).append(t.id)
        return members

    def hypotheses_of(self, tag: str) -> tuple[str, ...]:
        return next(t.hypotheses for t in self.tags if t.id == tag)

    def frame(self, spark: SparkSession) -> DataFrame:
        """(tag, position, tag_group, polarity, hypothesis), one row per hypothesis."""
        rows = [
            (t.id, position, t.group, t.polarity, h)
            for position, t in enumerate(self.tags)
            for h in t.hypotheses
        ]
        return spark.createDataFrame(
            rows, "tag string, position int, tag_group string, polarity string, hypothesis string"
        )

    def described(self, spark: SparkSession) -> DataFrame:
        """(tag, position, label, description, examples), one row per tag, for reports."""
        rows = [(t.id, k, t.label, t.description, list(t.examples)) for k, t in enumerate(self.tags)]
        return spark.createDataFrame(rows, "tag string, position int, label string, description string, examples array<string>")


# Version 1 of the taxonomy, in tie-breaking order.
V1 = Taxonomy(
    (
        Tag(
            "too_salty", "taste", "negative", ("too salty", "too much salt"), "Too salty",
            "Reviewer says the dish was overly salty or needed less salt.",
            ("way too salty", "next time I'll cut the salt in half"),
        ),
        Tag(
            "too_sweet", "taste", "negative", ("too sweet", "too much sugar"), "Too sweet",
            "Reviewer says the dish was overly sweet or needed less sugar/sweetener.",
            ("a bit too sweet for my taste", "I'll reduce the sugar next time"),
        ),
        Tag(
            "too_acidic", "taste", "negative", ("too sour", "too acidic"), "Too acidic",
            "Reviewer says the dish was overly acidic/sour/tangy or needed less acid (lemon/vinegar).",
            ("a bit too sour for my taste", "I'll reduce the vinegar next time", "I'll use less lemon juice next time"),
        ),
        Tag(
            "bland_lacks_flavor", "taste", "negative", ("bland", "needed more seasoning"), "Bland / lacks flavor",
            "Reviewer says it was bland or needed more seasoning/flavor.",
            ("kind of bland", "needed more spices"),
        ),
        Tag(
            "too_spicy", "taste", "negative", ("too spicy", "too hot"), "Too spicy",
            "Reviewer says the dish was too spicy/hot or needed less heat.",
            ("this was really spicy", "too hot for the kids", "too much spice"),
        ),
        Tag(
            "delicious_tasty", "taste", "positive", ("delicious", "tasted great"), "Delicious / tasty",
            "Reviewer explicitly praises taste or flavor (delicious, amazing, great flavor).",
            ("so delicious", "amazing flavor", "this was really tasty"),
        ),
        Tag(
            "dry", "texture", "negative", ("dry", "overcooked"), "Dry",
            "Reviewer says the dish came out dry or overcooked.",
            ("came out dry", "a little overcooked"),
        ),
        Tag(
            "mushy_soggy", "texture", "negative", ("soggy", "too watery"), "Mushy / soggy",
            "Reviewer says the result was mushy, soggy, watery, or lacked structure.",
            ("too soggy", "turned out watery"),
        ),
        Tag(
            "crispy_crunchy", "texture", "positive", ("crispy", "crunchy"), "Crispy / crunchy",
            "Reviewer praises crispness/crunchiness or a crunchy texture.",
            ("nice and crispy", "great crunch"),
        ),
        Tag(
            "moist_tender", "texture", "positive", ("moist and tender", "juicy"), "Moist / tender",
            "Reviewer praises moist, tender, juicy, or soft texture.",
            ("super moist", "tender and juicy", "nice and soft"),
        ),
        Tag(
            "easy_quick", "process", "positive", ("easy to make", "quick and easy"), "Easy / quick",
            "Reviewer says it was easy, simple, quick, or straightforward.",
            ("so easy", "quick weeknight dinner", "finished in 30 minutes"),
        ),
        Tag(
            "time_consuming_complex", "process", "negative", ("time consuming", "instructions were confusing"),
            "Time-consuming / complex",
            "Reviewer says it took a long time, was complicated, or instructions were unclear.",
            ("took forever", "instructions were confusing", "took much longer than expected"),
        ),
        Tag(
            "substitution_modification", "ingredients", "neutral", ("I substituted an ingredient", "I changed the recipe"),
            "Substitution / modification",
            "Reviewer describes substitutions or intentional changes to the recipe (swap/replace/add).",
            ("I used Greek yogurt instead of sour cream", "I doubled the garlic",
             "I used gluten-free flour instead of all-purpose flour"),
        ),
        Tag(
            "ingredient_issue", "ingredients", "negative", ("the ingredient amounts were off", "missing an ingredient"),
            "Ingredient issue",
            "Reviewer reports a true ingredient/ratio problem (amounts off, missing ingredient, ingredient didn't work).",
            ("needed more liquid", "too much garlic", "too much fat"),
        ),
        Tag(
            "would_make_again", "outcome", "positive", ("will make again", "a keeper"), "Would make again",
            "Reviewer indicates they would make it again, keep it, or recommend it.",
            ("this is a keeper", "will definitely make again"),
        ),
        Tag(
            "would_not_make_again", "outcome", "negative", ("won't make again", "would not recommend"),
            "Would NOT make again",
            "Reviewer indicates they would not make it again or would not recommend it.",
            ("won't be making this again", "would not recommend"),
        ),
        Tag(
            "family_hit", "outcome", "positive", ("a hit", "everyone loved it"), "Family hit / crowd pleaser",
            "Reviewer says others loved it (family loved it, a hit, crowd pleaser).",
            ("a big hit at our house", "everyone loved it", "the kids loved it"),
        ),
    )
)

# Fixed values: (positive, negative) tags that cannot both hold.
NEGATION_PAIRS = (
    ("would_make_again", "would_not_make_again"),
    ("delicious_tasty", "bland_lacks_flavor"),
    ("moist_tender", "dry"),
    ("crispy_crunchy", "mushy_soggy"),
    ("easy_quick", "time_consuming_complex"),
)


def taxonomy(version: str = "v1") -> Taxonomy:
    if version != "v1":
        raise ValueError(f"Unknown taxonomy version: {version}")
    return V1
