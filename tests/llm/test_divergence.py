"""Source divergence against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from orderlake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=3, top=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = Counter(TERM.findall((text or "").translate(lower)))
        counts[lang or "", source or ""].update(found)
        docs[lang or ""].update(found.keys())
    out = set()
    for la in docs:
        terms = [t for t, n in docs[la].items() if n >= least]
        groups = {s: c for (x, s), c in counts.items() if x == la}

        def shares(count):
            total = sum(count[t] for t in terms)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(terms)) for t in terms}

        share = {s: shares(c) for s, c in groups.items()}
        whole = shares(sum(groups.values(), Counter()))
        for s, p in share.items():
            pairs = [(o, sum((p[t] - q[t]) ** 2 // q[t] for t in terms)) for o, q in share.items() if o != s]
            best = [(t, (p[t] - whole[t]) ** 2 // whole[t]) for t in terms if groups[s][t] and p[t] > whole[t]]
            for part, found in (("pair", pairs), ("term", best)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:None if part == "pair" else top]
                out |= {(la, s, part, item, v, k) for k, (item, v) in enumerate(ranked, 1)}
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["The", "the", "été", "Été", "naïve", "x", "中文", "a1b", "don't", "q"] + [f"w{chr(97 + k)}" for k in range(26)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(n)]
    return [(t if rng.random() > 0.05 else None, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", None, "Ü"])) for t in texts]


@pytest.mark.parametrize("cells, groups", [(1 << 20, 20_000), (10, 20_000), (1, 0)])
def test_equal_to_plain_counting(spark, monkeypatch, cells, groups):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "GROUPS", groups)
    rows = corpus(1)
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    got = divergence.audit(df)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(got.dtypes)["rank"] == "int"
    assert rows_of(got) == brute(rows)
    assert rows_of(divergence.audit(df, top=3, least_docs=8)) == brute(rows, 8, 3)


def test_pieces_of_long_texts_count_a_document_once(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COUNTED", 64)
    rows = corpus(2) + [("only here " * 100, "en", "a"), ("é" * 500, "en", "a")]
    assert rows_of(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"))) == brute(rows)


def test_a_text_of_several_megabytes(spark):
    rows = [("Long words " * 400_000, "en", "a"), ("long", "en", "b"), ("long. LONG", "en", "b"), ("words", "en", "b")]
    assert rows_of(divergence.audit(spark.createDataFrame(rows, "text string, lang string, source string"))) == brute(rows)


def test_shares_are_exact_at_large_counts():
    import numpy as np

    for count, total, kept in [(10**14, 3 * 10**14, 10**9), (0, 0, 1), (9 * 10**14, 9 * 10**14, 7), (12345, 10**10, 10**8)]:
        assert divergence.proportion(np.array([count]), total, kept)[0] == 1 + 10**9 * (count + 1) // (total + kept)


def test_awkward_rows(spark, awkward, nothing):
    docs = awkward.selectExpr("*", "1 as term", "2 as n", "3 as docs", "4 as part2", "5 as item", "6 as value", "7 as total")
    assert rows_of(divergence.audit(docs)) == brute([(r["text"], r["lang"], r["source"]) for r in awkward.collect()])
    assert divergence.audit(nothing).count() == 0
    few = spark.createDataFrame([("a", "en", "x"), (None, "en", "y"), ("b", None, None)], "text string, lang string, source string")
    assert rows_of(divergence.audit(few)) == {("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)}
