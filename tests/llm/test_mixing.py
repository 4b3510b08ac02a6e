"""Weighted fair mixing: targets, nearness, and SQL on whole tables."""

import math
import re

import pytest
from pyspark.sql import functions as F

from orderlake.llm import mixing, queries
from orderlake.llm.frames import running_sum, word_count

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(epochs * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        level = left / max(1e-9, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] >= epochs * sizes[s]}
        if not over:
            return {s: epochs * sizes[s] if s in full else level * weight[s] for s in order}
        full |= over


def test_word_count_reads_blanks_as_the_contract_does(spark):
    texts = [None, "", " ", "a", " a", "a ", "\ta\x0bb\x0c\r\nc ", "a b", "é  ü", "\x1ca b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", word_count(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in enumerate(texts)}


def test_running_sum_counts_on_over_partitions(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as v", "(id * 37) % 1000 as o")
    got = {r.o: r.s for r in running_sum(df, [F.col("o")], "v", "s").collect()}
    rows = sorted((r.o, r.v) for r in df.collect())
    total = 0
    for o, v in rows:
        total += v
        assert got[o] == total


def test_targets_share_what_full_sources_leave(spark):
    sizes = {"b": 1000, "a": 10, "c": 500, None: 40, "é": 3000, "Z": 70}
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(sized, source="source", size="size").collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want) and all(math.isclose(got[s], want[s], rel_tol=1e-9) for s in want)
    assert math.isclose(sum(got.values()), 1.5 * sum(sizes.values()))


def test_query_is_near_its_targets_and_reruns_agree(spark):
    run = queries.QUERIES["op1_source_mix"]
    rows = run(spark, SF).collect()
    again = {r.doc_id: r.taken for r in run(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.taken for r in rows} == again and len(rows) == len(texts)
    largest, by = {}, {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")) and r.taken in (0, r.size, 2 * r.size)
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        by.setdefault(r.source, [r.source_size, r.target, 0])[2] += r.taken
    want = brute_targets({s: v[0] for s, v in by.items()})
    for s, (_, target, taken) in by.items():
        assert target == pytest.approx(want[s]) and abs(taken - target) <= largest[s] + max(largest.values()) * 0.5


def test_order_is_by_finish_time_and_stops_at_the_budget(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", 10 + i % 5) for i in range(300)], "doc_id long, source string, size long")
    sized = docs.selectExpr("doc_id as rid", "doc_id", "source", "size", "cast(0 as long) as tie")
    goals = mixing.targets(sized, source="source", size="size")
    rows = sorted(mixing.schedule(sized, goals).collect(), key=lambda r: r.spent)
    assert all(a.finish <= b.finish for a, b in zip(rows, rows[1:]))
    assert rows[-1].spent <= 1.5 * sum(10 + i % 5 for i in range(300)) < rows[-1].spent + 15


def test_awkward_rows(spark, awkward, nothing):
    sized = awkward.withColumn("size", word_count(F.col("text")))
    got = mixing.mix(sized, size="size", text="text").collect()
    assert len(got) == awkward.count()
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 and r.g == 12 and r.rid == 11 for r in got)
    assert {r.source for r in got} == {"a", "b", "c", None} and all(r.target is not None for r in got)
    assert mixing.mix(nothing.withColumn("size", word_count(F.col("text"))), size="size").collect() == []


def test_a_hot_source_in_many_partitions(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 11)) as source", "id % 50 as size")
    rows = mixing.mix(docs, size="size").collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(t - got) <= 100 for t, got in by.values())


def test_rows_equal_in_all_but_their_number_are_spread(spark):
    """A third of the rows share a null id and a size: they are many keys of the range partitions, not one."""
    rows = [(None if k % 3 == 0 else k, "a" if k % 2 else "b", 5) for k in range(3000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.mix(sized, size="size")
    taken = {r.source: r.t for r in out.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    goal = {r.source: r.target for r in out.select("source", "target").distinct().collect()}
    assert out.count() == 3000 and all(abs(taken[s] - goal[s]) <= 10 for s in goal)
    numbered = sized.withColumn("rid", F.monotonically_increasing_id()).withColumn("tie", F.lit(0).cast("long"))
    mixed = mixing.schedule(numbered, mixing.targets(numbered, source="source", size="size"))
    assert mixed.select("rid", "epoch").distinct().count() == mixed.count()
