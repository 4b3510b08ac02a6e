"""Winnowing against a plain reading, and the guarantee it gives."""

import hashlib
import random

import numpy as np

from orderlake.llm import queries, winnow
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def brute(text, k=winnow.K, w=winnow.W):
    if not text:
        return []
    k = min(k, len(text))
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    hashes = [int(winnow._hashes(code[i:i + k], k)[0]) >> 24 for i in range(len(text) - k + 1)]
    w, out = min(w, len(hashes)), []
    for s in range(len(hashes) - w + 1):
        low = min(hashes[s:s + w])
        at = max(i for i in range(s, s + w) if hashes[i] == low)
        if not out or out[-1] != (at, low):
            out.append((at, low))
    return out


def pairs(text, **kw):
    at, kept = winnow.winnow(text, **kw)
    return list(zip(at.tolist(), kept.tolist()))


def test_minima_and_rightmost_ties(monkeypatch):
    texts = [None, "", "a", "short", "é" * 13, "a" * 200, "ab" * 100, prose(1, 80), "😀" + prose(2, 30), prose(3, 60) * 2]
    want = [brute(t) for t in texts]
    assert [pairs(t) for t in texts] == want
    monkeypatch.setattr(winnow, "PIECE", 50)
    assert [pairs(t) for t in texts] == want
    assert [pairs(t, k=5, w=7) for t in texts] == [brute(t, 5, 7) for t in texts]


def test_shared_passages_share_a_hash_and_strings_read_back():
    rng = random.Random(1)
    for seed in range(20):
        shared = prose(100 + seed, 40)[:winnow.K + winnow.W - 1]
        a, b = prose(seed, rng.randrange(40)) + shared + prose(seed + 50, 9), prose(seed + 70, 20) + shared
        one, two = winnow.winnow(a), winnow.winnow(b)
        assert set(one[1].tolist()) & set(two[1].tolist())
        back = winnow.unpack(winnow.pack(*one))
        assert back[0].tolist() == one[0].tolist() and back[1].tolist() == one[1].tolist()
    assert winnow.pack(*winnow.winnow("")) == "" and winnow.likeness(set(), set()) == 1.0


def check(rows, got):
    order = sorted(rows)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        n, r = len(text), got[i]
        new = text[:n - n // 4] + following[:n // 4]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == winnow.pack(*winnow.winnow(text)) and r.edited_fingerprint == winnow.pack(*winnow.winnow(new))
        sets = [set(h for _, h in brute(t)) if n < 400 else set(winnow.winnow(t)[1].tolist()) for t in (text, new, following)]
        assert r.near_edited == winnow.likeness(sets[0], sets[1]) and r.near_next == winnow.likeness(sets[0], sets[2])


def test_query_over_the_whole_table(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op8_winnow"](spark, SF).collect()}
    check(rows, got)
    assert np.mean([r.near_edited for r in got.values()]) > 0.4 > 0.1 > np.mean([r.near_next for r in got.values()])


def test_next_document_across_ranges_and_alone(spark):
    rows = [(k * k - 50, prose(k, 1 + k % 7)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(rows, {r.doc_id: r for r in winnow.compare_with_next(df).collect()})
    check(rows[:1], {r.doc_id: r for r in winnow.compare_with_next(df.where("doc_id = -50")).collect()})


def test_awkward_rows(spark, awkward, nothing):
    got = winnow.compare_with_next(awkward).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in awkward.collect())
    assert all(r.fingerprint == "" and r.n_chars == 0 for r in got if r.doc_id in (2, 5))
    assert winnow.compare_with_next(nothing).collect() == []
    marked = winnow.fingerprints(awkward)
    assert marked.count() == awkward.count() and marked.schema["fingerprint"].dataType.typeName() == "string"
