import random

import pytest

WORDS = ["the", "of", "house", "river", "stone", "walk", "bright", "seven", "lamp", "garden", "über", "naïve", "x1", "go"]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) + (str(rng.randint(0, 99)) if rng.random() < 0.2 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, and columns whose names clash."""
    long = prose(1, 60_000)
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "same text here"), (5, "same  text here"), (6, "same  text\there"), (7, "same text here"),
        (8, prose(2, 300)), (9, prose(2, 300)), (9, prose(2, 300)), (None, prose(3, 200)), (None, prose(3, 200)),
        (10, long), (11, prose(4, 120) + " " + prose(5, 120)), (12, prose(6, 80) + " " + prose(5, 120)), (13, "12345 -- !!"),
    ]
    clash = ["key", "digest", "kept", "row", "content", "n", "_share", "c0", "lang_pred", "spans", "length", "block"]
    data = [(k, t, "en" if (k or 0) % 2 else None, *([None] * 6 + ["x"] * 6)) for k, t in rows]
    ddl = "doc_id bigint, text string, lang string, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame(data, ddl)


@pytest.fixture(scope="session")
def texts(odd):
    return [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
