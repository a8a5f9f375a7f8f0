"""Documents with every oddity at once, and their plain rows."""

from __future__ import annotations

import random

import pytest

LONG = " ".join(f"word{k % 977}" for k in range(60_000))
ROWS = [
    (1, ""),
    (2, None),
    (3, "one"),
    (4, "the quick brown fox jumps over the lazy dog, again and again."),
    (5, "the quick brown fox jumps over the lazy dog, again and again."),
    (5, "the quick brown fox jumps over the lazy dog, again and again."),
    (6, "The QUICK brown fox jumps over the lazy dog, again and again!"),
    (None, "a row without a key\nand with\tother  blanks "),
    (8, " \n\t 　"),
    (9, "漢字 テスト é ñ İ ß 'll don't \x1c x  y <|endoftext|> \U0001F600"),
    (10, LONG),
    (12, "z" * 3000),
]
FIELDS = "doc_id bigint, text string, k string, t string, ids string, key int, score double, part int, y int"


@pytest.fixture(scope="session")
def odd(spark):
    """The rows above with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*row, None, "t", "x", n, None, 7, 1) for n, row in enumerate(ROWS)], FIELDS).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def prose():
    """Random short texts with near copies."""
    rng = random.Random(4)
    texts = []
    for _ in range(60):
        words = [rng.choice(["alpha", "beta", "gamma", "delta", "of", "the"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 120))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            changed = list(words)
            changed[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(changed))
    return texts
