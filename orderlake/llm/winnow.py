"""Document fingerprints by winnowing.

Rolling hashes of all runs of ``k`` code points; of every window of ``w`` consecutive hashes
the smallest is kept, the rightmost of equal ones, with its position. Two texts that
share ``w + k - 1`` code points in a row share a kept hash (the match guarantee).

A fingerprint is a string: base64 of 9 bytes per kept hash, in text order: position
in code points (4 bytes) and hash (5 bytes), both big-endian. ``unpack`` reads it.
Likeness is the Jaccard index of the sets of kept hashes.

Defined results: a null or empty text has the empty fingerprint, and two of these are alike (1);
a text of fewer than ``k`` code points is one run; fewer than ``w`` runs are one window.
Long texts are hashed in pieces that overlap by a window, with the same result.
Equal texts have equal fingerprints. Ids are whole numbers, or texts of such: anything else is an error. Rows that repeat are judged each on its own; extra
columns pass through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.frames import cleared
from orderlake.llm.vectext import TaskCache, mix

K = 12
W = 32
#: Hashes of a text worked on at a time; with a window more still below 2**20, the room for positions.
PIECE = 1 << 18

_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_ENTRY = np.dtype([("pos", ">u4"), ("hash", "u1", 5)])
_PLACE = np.uint64((1 << 20) - 1)
_TABLES = TaskCache()


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _TABLES or len(_TABLES[base]) < n:
        out = np.full(max(n, 1 << 14), base, np.uint64)
        out[:1] = 1
        _TABLES[base] = np.multiply.accumulate(out)
    return _TABLES[base][:n]


def _hashes(code: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` code points."""
    n = len(code) - k + 1
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * _powers(_P, len(code)), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * _powers(_P_INV, n))


def _window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive keys, by doubling."""
    span = 1
    while span * 2 <= w:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[:span - w], keys[w - span:]) if span < w else keys


def winnow(text: str | None, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """(positions, 40-bit hashes) kept of one text."""
    code = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    k = min(k, len(code))
    runs = len(code) - k + 1
    w = min(w, runs)
    at, kept = [], []
    for lo in range(0, runs - w + 1, PIECE):
        count = min(PIECE, runs - w + 1 - lo) + w - 1  # hashes under the windows that start in this piece
        h = _hashes(code[lo:lo + count + k - 1], k) >> np.uint64(24) << np.uint64(20)
        # the place counts down, so of equal hashes the rightmost has the smallest key
        best = _window_minima(h | (_PLACE - np.arange(count, dtype=np.uint64)), w)
        best = best[np.concatenate(([True], best[1:] != best[:-1]))]
        at.append((_PLACE - (best & _PLACE)).astype(np.int64) + lo)
        kept.append(best >> np.uint64(20))
    at, kept = np.concatenate(at), np.concatenate(kept)
    new = np.concatenate(([True], at[1:] != at[:-1]))  # a piece may begin with the last one's choice
    return at[new], kept[new]


def pack(at: np.ndarray, kept: np.ndarray) -> str:
    entries = np.zeros(len(at), _ENTRY)
    entries["pos"] = at
    entries["hash"] = kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
    return base64.b64encode(entries.tobytes()).decode("ascii")


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    entries = np.frombuffer(base64.b64decode(fingerprint), _ENTRY)
    wide = np.zeros((len(entries), 8), np.uint8)
    wide[:, 3:] = entries["hash"]
    return entries["pos"].astype(np.int64), wide.view(">u8").reshape(-1).astype(np.uint64)


def likeness(a: set, b: set) -> float:
    """Jaccard index of two sets of kept hashes; two empty ones are alike."""
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def fingerprints(docs: DataFrame, *, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """``docs`` plus ``fingerprint``."""
    docs = cleared(docs, "fingerprint")
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            prints = [pack(*winnow(t.as_py(), k, w)) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], names=[*batch.schema.names, "fingerprint"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.StringType())]))


def _beside_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(bucket, ahead, no_id, id, th, text) sorted inside each bucket, a range of ids; the last row of each
    bucket (ahead = 1) is the first document after it, so every document stands before its next one.

    The text is shuffled once. Only cut points and first ids, one per bucket, reach the driver.
    """
    rows = docs.select(F.col(doc_id).isNull().alias("no_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    n = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.where(~F.col("no_id")).agg(F.percentile_approx("id", [i / n for i in range(1, n)], 20 * n).alias("c")).first()["c"] or []
    cuts = np.unique(np.array(cut, np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "left").astype(np.int32))

    dealt = rows.withColumn("bucket", F.when(F.col("no_id"), F.lit(len(cuts) + 1)).otherwise(bucket_of("id")))
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("no_id", "id", "th")).alias("f")).collect()  # a row per bucket
    order = sorted((r["bucket"], r["f"]["id"], r["f"]["th"]) for r in firsts)
    # the first row of each bucket also closes the bucket before it, and that of the first bucket the last one
    before = spark_rows(docs, [(b, i, h, order[k - 1][0]) for k, (b, i, h) in enumerate(order)])
    closing = (F.col("bucket") == F.col("b")) & (F.col("id") == F.col("i")) & (F.col("th") == F.col("h"))
    places = F.array(F.struct("bucket", F.lit(0).alias("ahead")))
    more = F.array(F.struct("bucket", F.lit(0).alias("ahead")), F.struct(F.col("closes").alias("bucket"), F.lit(1).alias("ahead")))
    placed = dealt.join(F.broadcast(before), closing, "left").withColumn(
        "p", F.explode(F.when(F.col("closes").isNull(), places).otherwise(more)))
    # a task for each bucket: by hash some tasks would get several
    return (placed.select("p.bucket", "p.ahead", "no_id", "id", "th", "text").repartitionById(len(cuts) + 2, F.col("bucket"))
            .sortWithinPartitions("bucket", "ahead", "no_id", "id", "th"))


def spark_rows(docs: DataFrame, rows: list[tuple]) -> DataFrame:
    return docs.sparkSession.createDataFrame(rows, "b int, i long, h long, closes int")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the first as many code points of ``following``."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def compare_with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The next document is the one of the next id, null ids last, equal ids by text hash; after the last comes the first.
    """
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType())])
    long_id = T.StructType([T.StructField(doc_id, T.LongType()), *schema.fields[1:]])

    def run(batches):
        held = None  # (bucket, id, text, positions, hashes, set) of the row that waits for its next one
        out: list[tuple] = []
        for batch in batches:
            bucket, ahead, no_id, ids, _, texts = (batch.column(c) for c in range(6))
            for b, a, none, i, t in zip(bucket.to_pylist(), ahead.to_pylist(), no_id.to_pylist(), ids.to_pylist(), texts):
                body = t.as_py() or ""
                at, kept = winnow(body, k, w)
                own = set(kept.tolist())
                if held and held[0] == b:
                    out.append(_compared(held, body, own, k, w))
                held = None if a else (b, None if none else i, body, at, kept, own)
                if len(out) >= 500:
                    yield _batch(out, long_id)
                    out = []
        if out:
            yield _batch(out, long_id)

    found = _beside_next(docs, doc_id, text).mapInArrow(run, long_id)
    return found.withColumn(doc_id, F.col(doc_id).cast(docs.schema[doc_id].dataType))


def _compared(held: tuple, following: str, next_set: set, k: int, w: int) -> tuple:
    _, i, body, at, kept, own = held
    changed = edited(body, following)
    at2, kept2 = winnow(changed, k, w)
    return (i, len(body), hashlib.sha256(changed.encode("utf-8")).hexdigest(), pack(at, kept), pack(at2, kept2),
            likeness(own, set(kept2.tolist())), likeness(own, next_set))


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=schema.names)
