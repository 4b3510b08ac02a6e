"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades 0 to 3 share one weight vector; ordered thresholds turn a text's score into
P(grade >= j) = sigmoid(w.x - t_j), and the sum of these is the expected severity.

Features of a text: how often each known word, 4-byte and 5-byte word beginning occurs
(log1p), how many words carry any of them, and how many of 100 words do (log1p both). Known features are those of the
labelled sample that mark toxic texts beyond chance: they stand in more distinct contexts (word before and
word after, so copies of one text count once) for each byte of toxic text than of other text.

Labels say toxic or not. Grade 0 is not toxic; toxic texts are graded 1 to 3 by the thirds of a cross-fitted share of
marked words: the marks that grade one half of the sample are learned on the other half, so severity means how much of a
text is abuse by marks that it did not help to choose, and no grade is a function of the model's own inputs.

The fit takes at most about ``max_per_class`` labelled texts of each class (the documented bound, by a hash
of the id), and of the features that pass the tests the ``max_features`` with the largest z (the bound of the model's size), so what reaches the driver has a fixed largest size; scoring covers every whole text.

Defined results: null and wordless texts have no feature and get the severity of an unmarked text; labels
without a value, or of unknown ids, count for nothing; if an id has several labels the largest holds; with labels of one class
only, nothing can be learned and every severity is 0. Rows that repeat are judged each on its own; extra
columns pass through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm import vectext
from orderlake.llm.frames import cleared, keep_lineage, share

MAX_PER_CLASS = 3000
MAX_FEATURES = 4096
GRADES = 3
SEED = 31
#: For a feature to be known: least contexts in toxic texts, least log of its rate in toxic texts to that in others, and
#: least times that log exceeds its standard error.
LEAST_CONTEXTS, LEAST_LOG_RATIO, LEAST_Z = 8, 3.0, 3.5
_STEPS, _RATE, _DECAY = 1000, 0.1, 1e-4

_DELIMITERS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def _features(column: pa.Array):
    """Per chunk: first row, rows, word hashes, hashes of word beginnings (3 arrays in all, equal length), row of each word."""
    classes = vectext.byte_class(_DELIMITERS)
    for lo, _, data, offsets in vectext.chunks(column):
        data = vectext.lowered(data)
        starts, ends, whole, first = vectext.words(data, offsets, classes)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        head, found = np.zeros(len(starts), np.uint64), [whole]
        for j in range(5):
            inside = starts + j < ends
            byte = data[np.minimum(starts + j, len(data) - 1)] if len(data) else np.zeros(0, np.uint8)
            head = head * np.uint64(257) + np.where(inside, byte.astype(np.uint64) + np.uint64(1), np.uint64(0))
            if j >= 3:
                found.append(vectext.mix(head + np.uint64(j << 50)))
        yield lo, len(offsets) - 1, found, row


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most: int) -> tuple[DataFrame, dict]:
    """(text, toxic, half) of at most about ``most`` labelled texts of each class, and the number of labels of each."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("labelled_id")) \
                  .agg((F.max(label) > 0).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit(SEED), "labelled_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic"), F.lit(min(1.0, most / max(1, counts.get(True, 0))))).otherwise(
        F.lit(min(1.0, most / max(1, counts.get(False, 0)))))
    chosen = F.broadcast(known.where(draw < share))  # about 2 * most ids
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(chosen, F.col("id") == F.col("labelled_id"))
    # one text for each id, also where ids repeat
    each = rows.groupBy("id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    return keep_lineage(each.select("text", "toxic", F.pmod(F.xxhash64(F.lit(SEED + 1), "id"), F.lit(2)).cast("int").alias("half"))), counts


def _known_features(sample: DataFrame, most: int) -> np.ndarray:
    """Sorted hashes of the features that mark toxic texts."""
    def presence(batches):
        for batch in batches:
            toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for lo, _, found, row in _features(batch.column(0)):
                around = np.concatenate((np.zeros(1, np.uint64), found[0], np.zeros(1, np.uint64)))
                context = vectext.mix(around[:-2] * np.uint64(3) + around[2:])
                of = toxic[lo + row]
                for f in found:
                    pairs = np.unique(np.stack([f, context, of.astype(np.uint64)], axis=1).view("V24").ravel()).view(np.uint64).reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64)),
                                                      pa.array(pairs[:, 2].astype(bool))], names=["f", "context", "toxic"])

    size = {r["toxic"]: r["size"] for r in sample.groupBy("toxic").agg(F.sum(F.octet_length("text")).alias("size")).collect()}
    if not size.get(True) or not size.get(False):
        return np.zeros(0, np.uint64)
    seen = sample.mapInArrow(presence, "f long, context long, toxic boolean").distinct().groupBy("f").agg(
        F.sum(F.col("toxic").cast("long")).alias("a"), F.sum((~F.col("toxic")).cast("long")).alias("b")).where(F.col("a") >= LEAST_CONTEXTS)
    # contexts for each byte of text: toxic texts may well be longer than others
    ratio = F.log((F.col("a") + 0.5) / float(size[True])) - F.log((F.col("b") + 0.5) / float(size[False]))
    z = ratio / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = seen.withColumn("z", z).where((F.col("z") >= LEAST_Z) & (ratio >= LEAST_LOG_RATIO)).orderBy(F.desc("z"), "f").limit(most)
    return np.sort(np.array([r["f"] for r in best.select("f").collect()], np.int64).view(np.uint64))


def _counted(column: pa.Array, known: np.ndarray):
    """Per chunk: rows, then (row, feature number, count) of known features, and per row the number of marked
    words and their share of 100 words."""
    for _, rows, found, row in _features(column):
        marked, keys = np.zeros(len(row), bool), []
        for h in found:
            at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
            hit = known[at] == h if len(known) else np.zeros(len(h), bool)
            marked |= hit
            keys.append(row[hit] * max(1, len(known)) + at[hit])
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        words = np.bincount(row, minlength=rows)
        dense = np.bincount(row[marked], minlength=rows)
        yield rows, key // max(1, len(known)), key % max(1, len(known)), count, np.stack([dense, 100.0 * dense / np.maximum(words, 1)])


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          max_per_class: int = MAX_PER_CLASS, max_features: int = MAX_FEATURES) -> dict:
    """Model as plain data: ``known`` feature hashes, their ``weights`` (those of number and share of marked words last) and ``thresholds``."""
    sample, labelled = _sample(docs, labels, doc_id, text, label, max_per_class)
    known = _known_features(sample, max_features)
    if not len(known):
        return {"known": known, "weights": np.zeros(2), "thresholds": np.full(GRADES, np.inf)}
    halves = [_known_features(sample.where(F.col("half") == k), max_features) for k in (1, 0)]  # each half is graded by the other's marks
    shared = share(docs, (known, *halves))

    def design(batches):
        for batch in batches:
            at = 0
            known, *marks = shared.value
            others = [np.concatenate([np.zeros(0), *(x[4][1] for x in _counted(batch.column(0), m))]) for m in marks]
            graded = np.where(np.asarray(batch.column(2)) == 0, *others)
            for rows, row, feature, count, (marked, share) in _counted(batch.column(0), known):
                cuts = np.searchsorted(row, np.arange(rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[at:at + rows], pa.array(graded[at:at + rows]), pa.array(marked), pa.array(share),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(feature.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.log1p(count)))],
                    names=["toxic", "graded", "marked", "share", "features", "values"])
                at += rows

    # as many rows as the sample's bound, each with known features only
    table = sample.mapInArrow(design, "toxic boolean, graded double, marked double, share double, features array<int>, values array<double>").toArrow().combine_chunks()
    toxic = table["toxic"].to_numpy().astype(bool)
    part = table["share"].to_numpy()
    lists = table["features"].combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    entries = (np.repeat(np.arange(len(toxic)), sizes), np.asarray(lists.flatten()).astype(np.int64),
               np.asarray(table["values"].combine_chunks().flatten()))
    graded = table["graded"].to_numpy()
    cut = np.quantile(graded[toxic], [k / GRADES for k in range(1, GRADES)])
    grade = np.where(toxic, 1 + np.searchsorted(cut, graded, "left"), 0)
    # the sample holds as many texts of each class; the labels need not
    weigh = np.where(toxic, labelled[True] / max(1, toxic.sum()), labelled[False] / max(1, (~toxic).sum()))
    weights, thresholds = fit(entries, np.log1p(np.stack([table["marked"].to_numpy(), part])), grade, len(known), weigh / weigh.mean())
    return {"known": known, "weights": weights, "thresholds": thresholds}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(entries: tuple[np.ndarray, np.ndarray, np.ndarray], dense: np.ndarray, grade: np.ndarray, n_features: int,
        weigh: np.ndarray):
    """Proportional-odds fit by full-batch Adam: sparse entries (row, feature, value), the two dense rows, grades
    from 0 and row weights."""
    row, feature, value = entries
    n, grades = len(grade), GRADES
    params = np.zeros(n_features + 2 + grades)
    params[-grades:] = np.concatenate(([1.0], np.zeros(grades - 1)))  # first threshold, then logs of the steps between them
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, _STEPS + 1):
        w, u = params[:n_features + 2], params[-grades:]
        gaps = np.exp(u[1:])
        t = np.concatenate(([u[0]], u[0] + np.cumsum(gaps)))
        eta = np.bincount(row, weights=value * w[feature], minlength=n) + w[-2:] @ dense
        above = np.concatenate([np.ones((n, 1)), _sigmoid(eta[:, None] - t), np.zeros((n, 1))], axis=1)
        own, over = above[np.arange(n), grade], above[np.arange(n), grade + 1]
        p = np.maximum(own - over, 1e-12)
        d_eta = weigh * (1 - own - over)
        d_t = np.zeros((n, grades + 2))
        d_t[np.arange(n), grade] -= weigh * own * (1 - own) / p
        d_t[np.arange(n), grade + 1] += weigh * over * (1 - over) / p
        d_t = d_t[:, 1:-1].sum(axis=0)
        grad = np.concatenate((np.bincount(feature, weights=value * d_eta[row], minlength=n_features), dense @ d_eta,
                               [d_t.sum()], [d_t[k + 1:].sum() * gaps[k] for k in range(grades - 1)])) / n
        grad[:n_features + 2] -= _DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        params += _RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    u = params[-grades:]
    return params[:n_features + 2], np.concatenate(([u[0]], u[0] + np.cumsum(np.exp(u[1:]))))


def score(docs: DataFrame, model: dict, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) plus p_toxic, severity (0 to 3), grade (most likely) and toxic."""
    added = ("p_toxic", "severity", "grade", "toxic")
    docs = cleared(docs, *added)
    keep = docs.columns if keep is None else keep
    kept, at = [docs.columns.index(c) for c in keep], docs.columns.index(text)
    shared = share(docs, model)

    def run(batches):
        known, w, t = (shared.value[k] for k in ("known", "weights", "thresholds"))
        for batch in batches:
            etas = [np.zeros(0)]
            for rows, row, feature, count, dense in _counted(batch.column(at), known):
                sparse = np.bincount(row, weights=np.log1p(count) * w[:-2][feature], minlength=rows) if len(known) else np.zeros(rows)
                etas.append(sparse + w[-2:] @ np.log1p(dense))
            above = _sigmoid(np.concatenate(etas)[:, None] - t)
            grades = np.concatenate((1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]), axis=1).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), pa.array(above[:, 0]), pa.array(above.sum(axis=1)),
                 pa.array(grades.astype(np.int32)), pa.array(above[:, 0] >= 0.5)], names=[*keep, *added])

    kinds = (T.DoubleType(), T.DoubleType(), T.IntegerType(), T.BooleanType())
    return docs.mapInArrow(run, T.StructType([*(docs.schema[k] for k in kept), *map(T.StructField, added, kinds)]))
