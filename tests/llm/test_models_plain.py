"""Language, quality and toxicity models against exact sets and dictionaries in plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from orderlake.llm import langid, quality, toxicity, vectext
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, [r.asDict() for r in docs.collect()], [r.asDict() for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]


def grams(text):
    """Four code points of the lower-cased text, runs of non-letters as one space, padded with spaces."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    line = re.sub(" +", " ", " " + letters + " ")
    return [(line + "    ")[i:i + 4] for i in range(len(line))]


def test_language_equals_exact_sets(spark):
    docs, rows, _ = tables(spark)
    model = langid.learn(docs)
    counts = defaultdict(Counter)
    for r in rows:
        if r["lang"] is not None and r["doc_id"] is not None and r["text"] is not None:
            counts[r["lang"]].update(grams(r["text"]))
    total = {la: sum(c.values()) for la, c in counts.items()}
    rate = {la: {g: n / total[la] for g, n in c.items() if n >= langid.MIN_COUNT} for la, c in counts.items()}
    best = defaultdict(float)
    for of in rate.values():
        for g, x in of.items():
            best[g] = max(best[g], x)
    members = {la: {g for g, x in of.items() if x >= langid.SHARE * best[g]} for la, of in rate.items()}
    assert model.langs == sorted(members)
    got = {r["doc_id"]: r for r in langid.predict(docs, model, keep=["doc_id"]).collect()}
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (got[r["doc_id"]]["lang_pred"], got[r["doc_id"]]["score"]) == ("und", 0.0)
            continue
        own = grams(r["text"])
        share = {la: sum(g in m for g in own) / len(own) for la, m in members.items()}
        top = max(share.values())
        found = got[r["doc_id"]]
        assert abs(found["score"] - top) < 0.01, r["doc_id"]
        assert share[found["lang_pred"]] > top - 0.01


def test_filters_grow_with_what_was_learned(spark):
    rng = random.Random(3)
    text = lambda: " ".join("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(9)) for _ in range(400))
    rows = [(k, t, "zh") for k in range(60) for t in [text() * 1]] * 1
    rows = [(i, t + " " + t, la) for i, t, la in rows] + [(100 + k, prose(k, 60), "en") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs, slot_bits=12)
    assert model.slot_bits > 12 and (model.false_rate ** (1 / langid.HASHES)).max() <= langid.FILL * 1.05
    got = langid.predict(docs, model, keep=["doc_id", "lang"]).collect()
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.9 for r in got)


def tokens(text):
    return re.findall(r"[\w\x80-\U0010ffff]+|[^\w\s\x80-\U0010ffff]+", text or "", re.ASCII)


def bucket_of(pair):
    """Bucket of a token or of two neighbours."""
    _, buckets, _, _ = next(iter(quality._buckets(pa.array([" ".join(pair)]), 14)))
    return int(buckets[-1])


def test_quality_equals_plain_counts(spark):
    docs, rows, labels = tables(spark)
    known: dict = {}

    def buckets(text):
        ts = tokens(text)
        return [known.setdefault(x, None) or known.__setitem__(x, bucket_of(x)) or known[x] for x in [(t,) for t in ts] + list(zip(ts, ts[1:]))]

    good = {r["doc_id"] for r in labels if r["quality"] == 1}
    short = [r for r in rows if len(r["text"] or "") < 4000]
    small = docs.where("text is null or length(text) < 4000")
    counts = np.full((2, 1 << 14), quality.SMOOTHING)
    of = {r["doc_id"]: buckets(r["text"]) for r in short}
    for r in short:
        np.add.at(counts[1], of[r["doc_id"]], 1)
        if r["doc_id"] in good:
            np.add.at(counts[0], of[r["doc_id"]], 1)
    want = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    ratio = quality.learn(small, spark.read.parquet(f"{SF}/labels.parquet"))
    assert np.allclose(ratio, want)
    for r in quality.score(small, ratio, keep=["doc_id"]).collect():
        assert r["n_grams"] == len(of[r["doc_id"]]) and math.isclose(r["log_ratio"], want[of[r["doc_id"]]].sum(), rel_tol=1e-9, abs_tol=1e-9)


def features_of(word):
    """Names of a word's features: itself and its first four and five bytes."""
    raw = word.encode()
    return [("w", raw)] + [(n, raw[:n]) for n in (4, 5)]


def toxic_words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower)


def test_toxicity_score_equals_plain_features(spark):
    docs, rows, labels = tables(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    hashes = {}
    for r in rows:
        column = pa.array([r["text"]], pa.string())
        for _, _, found, _ in toxicity._features(column):
            for word, *h in zip(toxic_words(r["text"]), *(f.tolist() for f in found)):
                for name, value in zip(features_of(word), h):
                    assert hashes.setdefault(name, value) == value
    assert len(set(hashes.values())) == len(hashes)  # a hash stands for one feature
    # the features that mark toxic texts, by distinct contexts
    truth = defaultdict(int)
    for r in labels:
        if r["toxic"] is not None:
            truth[r["doc_id"]] = max(truth[r["doc_id"]], r["toxic"])
    seen, size = defaultdict(set), Counter()
    for r in rows:
        if r["doc_id"] in truth and r["text"] is not None:
            words, toxic = toxic_words(r["text"]), truth[r["doc_id"]] > 0
            size[toxic] += len(r["text"].encode())
            for i, w in enumerate(words):
                for f in features_of(w):
                    seen[f].add((toxic, words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None))
    marks = set()
    for f, contexts in seen.items():
        a, b = (sum(t is k for t, _, _ in contexts) for k in (True, False))
        if a >= toxicity.LEAST_CONTEXTS:
            ratio = math.log((a + 0.5) / size[True]) - math.log((b + 0.5) / size[False])
            z = ratio / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
            if z >= toxicity.LEAST_Z and ratio >= toxicity.LEAST_LOG_RATIO:
                marks.add(f)
    learned = {n for n, h in hashes.items() if h in set(model["known"].tolist())}
    # contexts at the ends of a chunk are counted with the next text's words, which moves features at the limit
    assert len(learned ^ marks) <= 0.1 * max(1, len(marks))
    number = {h: k for k, h in enumerate(model["known"].tolist())}
    weights, thresholds = model["weights"], model["thresholds"]
    got = {r["doc_id"]: r for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    for r in rows:
        words = toxic_words(r["text"])
        count = Counter(number[hashes[f]] for w in words for f in features_of(w) if hashes[f] in number)
        marked = sum(any(hashes[f] in number for f in features_of(w)) for w in words)
        eta = sum(weights[k] * math.log1p(n) for k, n in count.items())
        eta += weights[-2] * math.log1p(marked) + weights[-1] * math.log1p(100 * marked / max(1, len(words)))
        above = [1 / (1 + math.exp(t - eta)) for t in thresholds]
        assert math.isclose(got[r["doc_id"]]["severity"], sum(above), rel_tol=1e-6, abs_tol=1e-9)


def test_grades_come_from_marks_of_the_other_half(spark):
    """Toxic texts with more abuse are graded higher although no text grades itself."""
    rng = random.Random(6)
    bad = ["zarg", "blick", "frum"]
    rows, labels = [], []
    for k in range(240):
        n = (k % 4) * 6
        words = prose(k, 60).split() + [rng.choice(bad) for _ in range(n)]
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(n > 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    severity = {r["doc_id"]: r["severity"] for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    means = [np.mean([s for k, s in severity.items() if k % 4 == level]) for level in range(4)]
    assert means == sorted(means) and means[0] < 0.5 and means[3] - means[1] > 0.8


def test_texts_of_several_megabytes(spark):
    text = prose(5, 330_000)
    assert len(text) > 2 << 20
    docs = spark.createDataFrame([(1, text, "en"), (2, prose(6, 50), "en"), (3, "zarg " * 50, "de")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in langid.predict(docs, langid.learn(docs), keep=["doc_id"]).collect()}
    assert found[1]["lang_pred"] == "en" and found[1]["score"] > 0.9
    scored = {r["doc_id"]: r for r in quality.score(docs, quality.learn(docs, labels), keep=["doc_id"]).collect()}
    assert scored[1]["n_grams"] == 2 * len(tokens(text)) - 1
    assert toxicity.score(docs, toxicity.learn(docs, labels)).count() == 3
    _, _, _, first = vectext.words(*vectext.utf8(pa.array([text])), vectext.byte_class(b" "))
    assert int(first[-1]) == len(text.split())
