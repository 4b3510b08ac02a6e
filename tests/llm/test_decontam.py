"""Benchmark decontamination against brute force over word lists."""

import hashlib
import os
import re

from orderlake.llm import decontam, queries
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, n=10):
    own, hit, found = words(text), set(), set()
    for i, t in items:
        w = words(t)
        size = min(n, len(w))
        windows = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if w else set()
        for k in range(len(own) - size + 1):
            if tuple(own[k:k + size]) in windows:
                hit |= set(range(k, k + size))
                found.add(str(i) if i is not None else "null")
    return len(own), len(hit), sorted(found, key=lambda s: s.encode())


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


ITEMS = [(1, prose(1, 25)), (10, prose(1, 12)), (2, "Short item"), (3, None), (4, " .. "), (None, prose(9, 15)), (2, "word")]


def test_scan_matches_brute_force_in_one_and_in_many_blocks(spark):
    texts = [prose(1, 40), "x " + prose(1, 25)[:80] + " y", "a SHORT, item! word short-item", prose(9, 15) + " " + prose(1, 12),
             None, "", "...", prose(5, 200), prose(1, 25) * 3, prose(9, 10), "é" + prose(1, 11)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (1_000_000, 60):
        got = decontam.scan(docs, bench(spark, ITEMS), block_words=block).collect()
        assert len(got) == len(texts)
        for r in got:
            assert (r.n_words, r.n_hit, r.hit_items) == brute(texts[r.doc_id], ITEMS), (block, r)
            assert sum(s.end_word - s.first_word for s in r.hit_spans) == r.n_hit
            assert all(a.end_word < b.first_word for a, b in zip(r.hit_spans, r.hit_spans[1:]))


def test_clean_cuts_spans_drops_half_hit_documents_and_leaves_the_rest(spark):
    clean, passage = prose(50, 80), prose(1, 25)
    half = passage.split(" ")
    # cutting the inner copy of the passage joins its two halves into another
    nested = clean + " " + " ".join(half[:12] + half + half[12:]) + " " + prose(51, 80)
    docs = spark.createDataFrame([(1, clean), (2, clean + "\n" + passage + "\n" + prose(51, 40)), (3, passage), (4, None), (5, nested)],
                                 "doc_id long, text string")
    items = [(7, passage)]
    for block in (1_000_000, 60):
        got = {r.doc_id: r.text for r in decontam.clean(docs, bench(spark, items), block_words=block).collect()}
        assert set(got) == {1, 2, 4, 5} and got[1] == clean and got[4] is None
        assert got[2].startswith(clean) and got[2].endswith(prose(51, 40))
        assert all(brute(t, items)[1] == 0 for t in got.values())


def brute_clean(text, items, share=0.5, n=10):
    """Words left of a text, None if it goes."""
    left, removed, total = words(text), 0, len(words(text))
    while True:
        hit = set()
        for _, t in items:
            w = words(t)
            size = min(n, len(w))
            windows = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if w else set()
            hit |= {j for k in range(len(left) - size + 1) if tuple(left[k:k + size]) in windows for j in range(k, k + size)}
        removed += len(hit)
        if not hit:
            return left
        if removed >= share * total:
            return None
        left = [w for k, w in enumerate(left) if k not in hit]


def test_clean_is_the_same_in_one_and_in_many_blocks(spark):
    passages = [prose(60 + k, 30).split(" ") for k in range(4)]
    p, q = passages[0], passages[1]
    items = [(k, " ".join(w)) for k, w in enumerate(passages)] + [(10, " ".join(p[8:] + q[:8])), (11, " ".join(p[20:] + passages[2][:12]))]
    own = [prose(80 + k, 60).split(" ") for k in range(4)]
    texts = [own[0][:20] + a + own[0][20:40] + b for a in passages for b in passages if a is not b]  # 60 of 100 words are hit by two items
    texts += [own[1] + p + q[:8] + own[2], own[1] + p[:28] + passages[2][:12] + own[2]]  # one item's cut leaves a piece of another's hit
    texts += [own[1] + a[:15] + b + a[15:] + own[2] + own[3] for a in passages for b in passages]  # a cut joins the halves of another item
    texts += [own[0], own[1] + p + own[2]] * 2
    lines = [" ".join(t) for t in texts] + [None, ""]
    docs = spark.createDataFrame([(k, k, t) for k, t in enumerate(lines)], "doc_id long, _h1 long, text string")
    want = {k: left for k, t in enumerate(lines) if (left := brute_clean(t, items)) is not None}
    assert 0 < len(want) < len(lines)
    for block in (1_000_000, 160, 60):
        got = decontam.clean(docs, bench(spark, items), block_words=block)
        assert got.columns == docs.columns
        got = {r.doc_id: r.text for r in got.collect()}
        assert {k: words(t) for k, t in got.items()} == want, block
        assert got[len(lines) - 2] is None and all(got[k] == lines[k] for k in got if words(lines[k]) == want[k])


def test_copies_enter_blocks_once_and_one_block_is_held_at_a_time(spark, monkeypatch):
    own = [(k, prose(100 + k, 30)) for k in range(4)]
    items = bench(spark, own + [own[0]] * 300)
    assert sum(b.count() for b in decontam._blocks(items, "item_id", "text", 200)) == len(own)
    seen, one_pass = [], decontam._one_pass

    def watched(docs, text, shared, *rest):
        assert not any(os.path.exists(s._path) for s in seen)
        seen.append(shared)
        return one_pass(docs, text, shared, *rest)

    monkeypatch.setattr(decontam, "_one_pass", watched)
    docs = spark.createDataFrame([(k, 1, t + " " + prose(k, 9) + " " + u) for k, (_, t) in enumerate(own) for _, u in own], "doc_id long, _h1 long, text string")
    got = decontam.scan(docs, items, block_words=200, drop_text=True)
    assert len(seen) > 2 and got.columns == ["doc_id", "_h1", "n_words", "n_hit", "hit_spans", "hit_items"]
    want = [(r.doc_id, *brute(r.text, own)) for r in docs.collect()]
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.hit_items) for r in got.collect()) == sorted(want)


def test_query_over_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.QUERIES["op9_decontaminate"](spark, SF).collect()
    assert len(got) == len(docs) and any(r.contaminated for r in got)
    for r in got:
        n, hit, found = brute(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_awkward_rows(spark, awkward, nothing):
    items = bench(spark, ITEMS)
    got = decontam.scan(awkward, items).collect()
    assert len(got) == awkward.count()
    assert sorted((r.n_words, r.n_hit) for r in got) == sorted(brute(r.text, ITEMS)[:2] for r in awkward.collect())
    assert decontam.scan(nothing, items).collect() == [] and decontam.clean(nothing, items).collect() == []
    cleaned = decontam.clean(awkward, items.limit(0))
    assert cleaned.columns == awkward.columns and sorted(map(str, cleaned.collect())) == sorted(map(str, awkward.collect()))


def test_words_of_texts_longer_than_a_segment(spark, monkeypatch):
    from orderlake.llm import vectext
    monkeypatch.setattr(vectext, "SEGMENT_BYTES", 64)
    monkeypatch.setattr(vectext, "CHUNK_BYTES", 256)
    import pyarrow as pa
    texts = [prose(3, 500), None, "x" * 1000, "", prose(4, 3), "é " * 300]
    windows = decontam.window_set([(str(i), t) for i, t in [(1, prose(3, 30))]], 10)
    got = list(decontam._scan_texts(pa.array(texts), windows))
    assert [g[0] for g in got] == [len(words(t)) for t in texts]
    assert sum(b - a for a, b in got[0][1]) == brute(texts[0], [(1, prose(3, 30))])[1]
