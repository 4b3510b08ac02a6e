"""Generic building blocks: two-level running scans and connected components."""

import random

import pytest
from pyspark.sql import functions as F

from orderlake.operators.components import connected_components
from orderlake.operators.lifecycle import scan_before


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_scan_before_matches_python_with_a_hot_key(spark, chunk):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}"   # one key holds a third of the rows
        rows.append((key, rnd.randrange(200), i, rnd.random() < 0.3, rnd.randrange(1000)))
    df = spark.createDataFrame(rows, "k string, block long, tx int, flag boolean, val int")
    out = scan_before(df, "k", F.floor(F.col("block") / chunk), ["block", "tx"], [
        ("any_flag", "any", None, F.col("flag")),
        ("first_val", "first", F.col("val"), F.col("flag")),
        ("last_val", "last", F.col("val"), F.col("flag")),
    ]).collect()
    got = {(r.k, r.block, r.tx): (r.any_flag, r.first_val, r.last_val) for r in out}
    want = {}
    for key in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(seq):
            earlier = [x for x in seq[:i] if x[3]]
            want[(key, r[1], r[2])] = (bool(earlier), earlier[0][4] if earlier else None,
                                       earlier[-1][4] if earlier else None)
    assert got == want


def test_components_on_a_long_chain(spark):
    n = 300
    v = spark.range(n).select(F.col("id").alias("v"))
    e = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    extra_v = spark.range(1000, 1010).select(F.col("id").alias("v"))          # isolated vertices
    lab = connected_components(v.unionByName(extra_v), e)
    got = {r.v: r.label for r in lab.collect()}
    assert all(got[i] == 0 for i in range(n))
    assert all(got[i] == i for i in range(1000, 1010))


def test_components_of_components_plan_in_bounded_time(spark):
    """Each call starts from the labels of the call before; size estimates must not pile up from round to round."""
    import time

    n = 3000
    vertices = spark.range(n).select(F.col("id").alias("v"))
    labels = connected_components(vertices, spark.range(0).select(F.col("id").alias("src"), F.col("id").alias("dst")))
    began = time.time()
    for step in (1, 2, 4, 8):
        edges = labels.select(F.col("v").alias("src"), (F.col("v") + step).alias("dst")).where(
            (F.col("src") % (2 * step) == 0) & (F.col("dst") < n))
        both = edges.join(labels.select(F.col("v").alias("src"), F.col("label").alias("a")), "src").join(
            labels.select(F.col("v").alias("dst"), F.col("label").alias("b")), "dst")
        tops = connected_components(labels.select(F.col("label").alias("v")), both.select(F.col("a").alias("src"), F.col("b").alias("dst")))
        labels = labels.join(tops.select(F.col("v").alias("label"), F.col("label").alias("top")), "label").select("v", F.col("top").alias("label"))
    assert {r["v"]: r["label"] for r in labels.collect()} == {i: i // 16 * 16 for i in range(n)}
    assert time.time() - began < 60
