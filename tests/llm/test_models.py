"""Quality sampling and toxicity: held-out results, the fits, and defined cases."""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from orderlake.llm import quality, queries, toxicity
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.1"


def auc(score, good):
    rank = np.argsort(np.argsort(score))
    good = np.array(good, bool)
    n = good.sum()
    return (rank[good].sum() - n * (n - 1) / 2) / (n * (len(good) - n))


def test_log_ratios_tell_held_out_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    even, odd = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    scored = quality.score(docs, quality.learn(docs, even), keep=["doc_id"]).join(odd, "doc_id").collect()
    assert auc([r.log_ratio / max(1, r.n_grams) for r in scored], [r.quality == 1 for r in scored]) > 0.97


def test_buckets_match_a_plain_count():
    def tokens(t):
        return re.findall(r"[\w\x80-\U0010ffff]+|[^\w\s\x80-\U0010ffff]+", t or "")
    texts = ["a a b, c!!", None, "", prose(1, 50), "%% %%", "word"]
    counts = {}
    for lo, buckets, row, rows in quality._buckets(pa.array(texts), 14):
        for r, b in zip(row.tolist(), buckets.tolist()):
            counts.setdefault(lo + r, []).append(b)
    for k, t in enumerate(texts):
        ts = tokens(t)
        assert len(counts.get(k, [])) == max(0, 2 * len(ts) - 1)
        repeats = sum(a == b for a, b in zip(ts, ts[1:]))
        assert counts.get(k, []).count(0) >= repeats


def test_top_k_follows_weight_and_noise(spark):
    scored = spark.range(2000).selectExpr("id as doc_id", "cast(1 as long) as n_grams", "if(id % 2 = 0, 2.0D, 0.0D) as log_ratio")
    rows = quality.gumbel_top_k(scored, order=["doc_id"], k=500).collect()
    chosen = [r for r in rows if r.selected]
    assert len(chosen) == 500 and min(r.gumbel_key for r in chosen) >= max(r.gumbel_key for r in rows if not r.selected)
    share = np.mean([r.doc_id % 2 == 0 for r in chosen])  # weights e**2 to 1, without replacement
    assert 0.75 < share < 0.92
    again = {r.doc_id for r in quality.gumbel_top_k(scored.repartition(5), order=["doc_id"], k=500).collect() if r.selected}
    assert again == {r.doc_id for r in chosen}


def test_quality_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, None, None), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    ratio = quality.learn(awkward, labels)
    rows = quality.gumbel_top_k(quality.score(awkward, ratio), order=["doc_id", "text"]).collect()
    assert len(rows) == awkward.count()
    assert all(r.gumbel_key is None and not r.selected and r.log_ratio == 0 for r in rows if not (r.text or "").strip())
    assert not quality.learn(awkward, labels.limit(0)).any() and quality.score(nothing, ratio).collect() == []


def test_held_out_toxicity(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.learn(docs, labels.where("doc_id % 2 = 0"))
    assert (np.diff(model["thresholds"]) > 0).all()
    rows = toxicity.score(docs, model, keep=["doc_id"]).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "truth"), "doc_id").collect()
    hit = [r.toxic for r in rows if r.truth == 1]
    false = [r.toxic for r in rows if r.truth == 0]
    assert np.mean(hit) > 0.85 and np.mean(false) < 0.02
    assert all(0 <= r.severity <= toxicity.GRADES and 0 <= r.p_toxic <= 1 for r in rows)


def test_ordinal_fit_recovers_order_and_shared_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 2))
    eta = 2 * x[:, 0] - x[:, 1] + rng.logistic(size=3000)
    grade = np.digitize(eta, [-1, 0.5, 2])
    row, feature = np.repeat(np.arange(3000), 2), np.tile([0, 1], 3000)
    w, t = toxicity.fit((row, feature, x.ravel()), np.zeros((2, 3000)), grade, 2, np.ones(3000))
    assert np.allclose(w[:2], [2, -1], atol=0.25) and np.allclose(t, [-1, 0.5, 2], atol=0.3)


def test_toxicity_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, None), (99, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(awkward, labels)
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == awkward.count() and all(not math.isnan(r.severity) for r in rows)
    one_class = toxicity.learn(awkward, labels.where("toxic = 0"))
    assert {r.severity for r in toxicity.score(awkward, one_class).collect()} == {0.0}
    assert toxicity.score(nothing, model).collect() == [] and toxicity.score(awkward, model).where(F.col("grade").isNull()).count() == 0
