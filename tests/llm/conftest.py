import random

import pytest

WORDS = [a + b + c for a in ("ka", "lo", "mi", "ru") for b in ("te", "so", "na", "pi") for c in ("", "n", "rs", "x")]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and very long texts, repeats, one id with two texts, and columns named as the operators' own."""
    base = prose(1, 120)
    rows = [
        (1, base, "en", "a", len(base)), (2, base, "en", "a", len(base)), (2, base, "en", "a", len(base)),
        (3, base + " tail", None, "a", 0), (3, prose(2, 90), "en", None, 0), (None, prose(3, 60), "en", "b", 0), (None, None, None, None, None),
        (4, "", "en", "b", 0), (5, " \n\t ", "fr", "b", 3), (6, "one two", "fr", "b", 7), (7, prose(4, 40_000), "en", "c", 0),
        (8, "x" * 1_300_000, "en", "c", 0), (9, "Émile ÉMILE émile 12 -- !!", "fr", "c", 0), (10, "a b c d e " * 400, "fr", "c", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: "'own'" for c in ("score", "th", "sid", "n", "token", "found", "k_id", "k_th", "doc", "rest", "w", "g", "topic", "weight", "y", "anchor", "place")}
    return df.selectExpr("*", *[f"{v} as {k}" for k, v in extra.items()])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
