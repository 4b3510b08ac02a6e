"""SimHash near-dedup against brute force over all pairs."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from orderlake.llm import queries, simhash

SF = "/root/testdata/sf0.001"


def brute_print(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), seed=42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance=3):
    """{value: smallest value reachable}"""
    top = {x: x for x in prints}
    changed = True
    pairs = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= distance]
    while changed:
        changed = False
        for a, b in pairs:
            m = min(top[a], top[b])
            changed |= top[a] != m or top[b] != m
            top[a] = top[b] = m
    return top


def test_query_matches_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in docs.items()}
    top = brute_classes(set(prints.values()))
    first = {}
    for i in sorted(prints):
        first.setdefault(top[prints[i]], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op6_simhash"](spark, SF).collect()}
    assert got == {i: (f"{p:016x}", first[top[p]]) for i, p in prints.items()}


def test_links_lose_nothing_when_shards_are_split_again(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = {b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base[:10] for _ in range(40)}
    dense = {rng.getrandbits(9) << 20 for _ in range(300)}  # all in a few shards of the first split
    values = sorted(set(base) | near | dense | {0})
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    prints = spark.createDataFrame(signed, "fp long")
    for nodes in (40, 100_000):
        edges = simhash.links(prints, shard_nodes=nodes).collect()
        top = {v: v for v in values}
        changed = True
        while changed:
            changed = False
            for e in edges:
                a, b = e.src % (1 << 64), e.dst % (1 << 64)
                m = min(top[a], top[b])
                changed |= top[a] != m or top[b] != m
                top[a] = top[b] = m
        assert top == brute_classes(values)


def test_bk_tree_finds_what_is_within_the_radius():
    rng = random.Random(4)
    values = [rng.getrandbits(12) for _ in range(500)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for x in values[:50]:
        assert sorted(tree.within(x, 3)) == sorted(v for v in set(values) if (v ^ x).bit_count() <= 3)
    assert simhash.BKTree().within(1, 3) == []


def test_long_texts_are_voted_in_pieces():
    text = " ".join(str(k * k % 977) for k in range(70_000))
    assert simhash.text_fingerprint(text) == brute_print(text)
    assert simhash.text_fingerprint("a") == brute_print("A") and simhash.text_fingerprint(None) == 0


def test_awkward_rows(spark, awkward, nothing):
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    zero = [r for r in got if r.fingerprint == 0]
    assert {r.doc_id for r in zero} >= {2, 5, 6} and {r.component_id for r in zero} == {2}
    assert simhash.near_duplicates(nothing).collect() == []
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns and simhash.keep_one(nothing).collect() == []
    rows = kept.collect()
    assert len([r for r in rows if not (r.text or "").strip()]) == 1
    assert len([r for r in rows if r.doc_id == 1]) == 2 and len([r for r in rows if r.doc_id is None]) == 1


def test_a_class_keeps_its_smallest_id(spark):
    text = " ".join(f"w{k}" for k in range(400))
    docs = spark.createDataFrame([(9, text), (4, text + " x"), (6, text), (None, text)], "doc_id long, text string")
    assert [r.doc_id for r in simhash.keep_one(docs).collect()] == [4]
    assert simhash.near_duplicates(docs).select("component_id").distinct().collect()[0][0] == 4
    assert simhash.near_duplicates(docs).where(F.col("component_id") != 4).count() == 0
