import random

import pytest

WORDS = ["the", "and", "alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "Ünder", "naïve", "tree", "House", "été"]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and blank texts, a long text, rows that repeat, equal ids, and columns whose
    names clash with results and with names used inside."""
    rows = [(1, prose(1, 60), "en", "a"), (1, prose(1, 60), "en", "a"), (1, prose(2, 30), "en", "b"), (2, None, None, None),
            (None, prose(3, 40), "de", "b"), (None, prose(3, 40), "de", "b"), (None, None, None, None), (5, "", "en", "c"),
            (6, " \t\r\n ", None, "c"), (7, prose(7, 30_000), "en", None), (8, "word", "fr", "a"), (9, "12 %% !!", "fr", "a")]
    names = ["fingerprint", "score", "n_hit", "taken", "k1", "_k1", "first", "label", "toxic", "spans", "size2", "rid", "g", "pos", "part"]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for k, name in enumerate(names):
        frame = frame.selectExpr("*", f"{k} as {name}")
    return frame


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
