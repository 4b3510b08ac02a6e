"""Periodic runs against a walk along every diagonal."""

import hashlib
import random
import re
import time
import zlib

from orderlake.llm import periodic, queries
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def brute(words, least=12):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(least, 2 * q):
                best.setdefault((a, i + q), q)
    return sorted(((a, b - a, q) for (a, b), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def made(rng):
    kind, n = rng.randrange(6), rng.randrange(0, 170)
    if kind < 2:
        return [rng.choice("abc"[:kind + 2]) for _ in range(n)]
    if kind == 2:
        out = []
        while len(out) < n:
            root = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
            out += (root * 9)[:rng.randrange(1, 60)]
        return out
    if kind == 3:
        return fibonacci(n)
    if kind == 4:
        root = [rng.choice("ab") for _ in range(rng.randrange(1, 40))]
        return (root * 6)[:n] + [rng.choice("abx")] + (root * 6)[:n]
    return list("a" * rng.randrange(60) + "b" + "a" * rng.randrange(60) + "b" + "a" * rng.randrange(60))


def test_equal_to_every_diagonal():
    rng = random.Random(5)
    for least in (12, 12, 12, 13, 5, 20, 2):
        for _ in range(250):
            docs = [made(rng) for _ in range(rng.randrange(1, 4))]
            words, ids, bounds = periodic.numbered([" ".join(d).encode() for d in docs])
            assert [[w.decode() for w in d] for d in words] == docs
            assert periodic.runs(ids, bounds, least) == [brute(d, least) for d in docs], (least, docs)


def test_long_repetitive_texts_take_no_square_time():
    rng = random.Random(2)
    texts = [["a"] * 100_000, [rng.choice("ab") for _ in range(100_000)], fibonacci(100_000), [f"w{i}" for i in range(500)] * 200]
    began = time.time()
    for words in texts:
        _, ids, bounds = periodic.numbered([" ".join(words).encode()])
        found = periodic.runs(ids, bounds)[0]
        for s, n, q in found[:200] + found[-200:]:
            assert words[s:s + n - q] == words[s + q:s + n] and n >= max(12, 2 * q)
            assert (s == 0 or words[s - 1] != words[s - 1 + q]) and (s + n == len(words) or words[s + n] != words[s + n - q])
    assert found == [(0, 100_000, 500)] and time.time() - began < 30


def test_kept_words():
    rng = random.Random(8)
    for _ in range(200):
        words = made(rng)
        found = brute(words)
        stay = periodic.kept(len(words), found)
        assert " ".join(w for w, s in zip(words, stay) if s) == collapsed(words, found)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_query(spark, monkeypatch):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op12_periodic(spark, SF).collect()}
    assert got.keys() == rows.keys()
    some = 0
    for i, text in rows.items():
        words, h = words_of(text), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        if n > 3000:
            continue
        found, r = brute(words), got[i]
        some += bool(found)
        assert r["n_runs"] == len(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
    assert some > 10


def test_awkward_rows(spark, awkward, nothing):
    again = "one two three\t" * 20
    docs = awkward.unionByName(awkward.limit(1).selectExpr("cast(90 as bigint) doc_id", f"'{again}' text", "lang", "source", *awkward.columns[4:]))
    docs = docs.withColumn("RUNS", docs.k1).withColumn("collapsed", docs.g)
    found = periodic.find(docs)
    assert found.columns == [*awkward.columns, "runs", "collapsed"]
    for r in found.collect():
        words = words_of(r["text"])
        want = brute(words[:5000]) if len(words) > 5000 else brute(words)
        assert [tuple(x) for x in r["runs"]] == want and r["collapsed"] == collapsed(words, want)
    assert periodic.find(nothing).count() == 0


def test_small_pieces_and_a_text_of_megabytes(spark, monkeypatch):
    monkeypatch.setattr(periodic, "WORDS", 50)
    text = prose(4, 200_000) + " x y" * 50_000
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([text, "a b " * 30, None, "a b " * 40, ""])], "id int, text string")
    found = {r["id"]: [tuple(x) for x in r["runs"]] for r in periodic.find(docs, drop_text=True).collect()}
    assert found == {0: [(200_000, 100_000, 2)], 1: [(0, 60, 2)], 2: [], 3: [(0, 80, 2)], 4: []}
