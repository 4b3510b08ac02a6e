"""Quality by importance resampling.

Two generative models over hashed n-grams: one of target texts (those labelled good)
and one of all raw texts. A text's importance is its log likelihood ratio under the
two, and a sample is drawn by Gumbel top-k: each text gets its log importance plus
Gumbel noise (from a hash of id and text, so reruns agree) and the k largest stay.

Tokens are runs of word characters and runs of other visible ASCII; n-grams are single
tokens and pairs, hashed to ``2**bucket_bits`` buckets. A token that repeats the one before it goes to
one bucket of its own, whatever it is.

Counts cover every raw text and all target texts among at most about ``max_labelled`` labelled ids
(the documented bound of the fit, chosen by a hash of the id). The models have a fixed size.

Defined results: a null text, or one without a token, has log importance 0, no Gumbel key and
is never selected; labels of unknown ids or without a value count for nothing; with no target text every ratio is 0
and nothing beyond chance is preferred; rows that repeat are judged each on its own and share key and
selection order. Without ``k``, as many texts are drawn as have a positive ratio. Extra columns pass
through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm import vectext
from orderlake.llm.frames import cleared, fresh, keep_lineage, running_sum, share

BUCKET_BITS = 14
MAX_LABELLED = 50_000
SEED = 23
#: Added to each bucket's count.
SMOOTHING = 0.1

_BLANK = bytes([*range(0x21), 0x7F])
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "_")


def _buckets(column: pa.Array, bits: int):
    """Per chunk: first row, n-gram buckets of all rows in turn, and the row of each."""
    classes = vectext.byte_class(_BLANK, _MARKS)
    shift = np.uint64(64 - bits)
    for lo, _, data, offsets in vectext.chunks(column):
        _, _, hashes, first = vectext.words(data, offsets, classes)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        pair = vectext.rolling(hashes, 2) >> shift
        if len(hashes) > 1:
            pair[hashes[1:] == hashes[:-1]] = 0
        inside = row[1:] == row[:-1]
        yield lo, np.concatenate((hashes >> shift, pair[inside])).astype(np.int64), np.concatenate((row, row[1:][inside])), len(offsets) - 1


def labelled_ids(labels: DataFrame, doc_id: str, most: int, seed: int = SEED) -> DataFrame:
    """Distinct ids of ``labels``, about ``most`` of them at most by a hash of the id."""
    ids = labels.select(F.col(doc_id).alias("labelled_id")).where("labelled_id is not null").distinct()
    count = ids.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), "labelled_id"), F.lit(1 << 30)) / float(1 << 30)
    return ids.where(draw < min(1.0, most / max(1, count)))


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          max_labelled: int = MAX_LABELLED, bucket_bits: int = BUCKET_BITS) -> np.ndarray:
    """Log ratio of target to raw probability of each bucket."""
    good = labelled_ids(labels.where(F.col(label) == 1), doc_id, max_labelled)
    # at most about max_labelled ids
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(good), F.col("id") == F.col("labelled_id"), "left").select("text", F.col("labelled_id").isNotNull().alias("good"))
    size = 1 << bucket_bits

    def count(batches):
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            is_good = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for lo, buckets, row, _ in _buckets(batch.column(0), bucket_bits):
                total[0] += np.bincount(buckets[is_good[lo + row]], minlength=size)
                total[1] += np.bincount(buckets, minlength=size)
        seen = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[0][seen]), pa.array(total[1][seen])],
                                         names=["bucket", "good", "raw"])

    # one row per bucket, so a table of fixed size
    found = rows.mapInArrow(count, "bucket int, good long, raw long").groupBy("bucket").agg(
        F.sum("good").alias("good"), F.sum("raw").alias("raw")).toArrow()
    n = np.full((2, size), SMOOTHING)
    for k, name in enumerate(("good", "raw")):
        n[k, found["bucket"].to_numpy()] += found[name].to_numpy()
    if n[0].sum() <= SMOOTHING * size * 1.000001:  # no target text
        return np.zeros(size)
    return np.log(n[0] / n[0].sum()) - np.log(n[1] / n[1].sum())


def score(docs: DataFrame, ratio: np.ndarray, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) plus n_grams and log_ratio (sum over the text's n-grams)."""
    docs = cleared(docs, "n_grams", "log_ratio")
    keep = docs.columns if keep is None else keep
    kept, at = [docs.columns.index(c) for c in keep], docs.columns.index(text)
    shared, bits = share(docs, ratio), int(len(ratio)).bit_length() - 1

    def run(batches):
        for batch in batches:
            grams, ratios = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, buckets, row, rows in _buckets(batch.column(at), bits):
                grams.append(np.bincount(row, minlength=rows))
                ratios.append(np.bincount(row, weights=shared.value[buckets], minlength=rows))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(np.concatenate(grams)),
                                              pa.array(np.concatenate(ratios))], names=[*keep, "n_grams", "log_ratio"])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[k] for k in kept), T.StructField("n_grams", T.LongType()),
                                              T.StructField("log_ratio", T.DoubleType())]))


def gumbel_top_k(scored: DataFrame, *, order: list[str], k: int | None = None, weight: str = "log_ratio",
                 eligible: str = "n_grams", seed: int = SEED) -> DataFrame:
    """``scored`` plus gumbel_key (null for rows without n-grams) and selected.

    ``order`` names columns whose hash gives each row's noise and that settle ties.
    """
    scored = cleared(scored, "gumbel_key", "selected")
    one, rank = fresh(scored, "_one", "_rank")
    unit = (F.pmod(F.xxhash64(F.lit(seed), *order), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = keep_lineage(scored.withColumn("gumbel_key", F.when(F.col(eligible) > 0, F.col(weight) - F.log(-F.log(unit)))))
    if k is None:
        k = keyed.where((F.col(weight) > 0) & F.col("gumbel_key").isNotNull()).count()
    # the rank comes from range partitions and their counts, not from one sorted task
    ranked = running_sum(keyed.withColumn(one, F.col("gumbel_key").isNotNull().cast("long")),
                         [F.col("gumbel_key").desc_nulls_last(), *[F.col(c) for c in order]], one, rank)
    return ranked.withColumn("selected", F.col("gumbel_key").isNotNull() & (F.col(rank) <= F.lit(k))).drop(one, rank)
