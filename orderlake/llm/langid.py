"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: slot ``s`` holds a bitmask with
bit ``l`` set if the filter of language ``l`` has ``s`` set. The AND of an n-gram's
slots is the set of all languages that contain it. A text's popcount per
language, less the false positives that the filter's fill predicts, decides.

N-grams are four code points of the lower-cased text with every run of
non-letters as one space. A language's filter holds the n-grams whose rate in its
training texts reaches ``SHARE`` of their highest rate in any language, so a few
foreign lines in the training texts do not open a filter to another language.

Learning takes at most about ``docs_per_lang`` labelled texts of each language, chosen by
a hash of the id (the documented bound of the fit); prediction covers every text.
The table of slots has ``2**slot_bits`` masks, or more: as many as keep the fullest language's filter below
``FILL``. The sample bounds the n-grams and so the table.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a
text none of whose n-grams is known gets the language with most training documents and score 0;
ties go to the first language by code point; with nothing learned every text is ``und``.
Rows without a label or id are not learned from. Rows that repeat are judged each on its
own; extra columns pass through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.frames import cleared, keep_lineage, share
from orderlake.llm.vectext import TaskCache, chunks, mix

N = 4
SLOT_BITS = 20
HASHES = 3
#: Share of a filter's slots that its language's n-grams may set.
FILL = 0.3
DOCS_PER_LANG = 4000
#: An n-gram belongs to a language if its rate there is at least this part of its highest rate.
SHARE = 0.2
#: Least times an n-gram is seen in a language's texts.
MIN_COUNT = 2
#: Most languages whose numbers are broadcast; beyond that the join shuffles.
BROADCAST_LANGS = 10_000
_SPACE = 32


@dataclass(frozen=True)
class Model:
    langs: list[str]
    #: Masks by slot: (words of 64 languages, slots), in the narrowest type for up to 64 languages.
    slots: np.ndarray
    #: Probability that an n-gram of no language passes the filter of each.
    false_rate: np.ndarray
    usual: int
    slot_bits: int


_LETTERS = TaskCache()


def _letters(code: np.ndarray) -> np.ndarray:
    """Which code points are letters; a table for the planes with alphabets, and ideographs beyond it."""
    if not _LETTERS:
        _LETTERS["table"] = np.fromiter((chr(c).isalpha() for c in range(0x20001)), bool, 0x20001)
    return _LETTERS["table"][np.minimum(code, 0x20000)] & (code < 0xE0000)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all n-grams, number of the first of each text with the total at the end, whether each text has a letter)."""
    lower = [(t or "").lower() for t in texts]
    sizes = np.fromiter(map(len, lower), np.int64, len(lower))
    # each text stands between one space and as many as make its last n-grams whole
    code = np.frombuffer((" " + (" " * N).join(lower) + " " * N).encode("utf-32-le", "replace"), np.uint32)
    starts = np.concatenate(([0], np.cumsum(sizes + N)))  # the space before each text
    letter = _letters(code)
    letters_before = np.concatenate(([0], np.cumsum(letter)))
    has_letter = letters_before[starts[1:]] > letters_before[starts[:-1]]
    code = np.where(letter, code, _SPACE).astype(np.uint64)
    # the spaces that only fill the last n-grams of a text, so that none runs into the next text
    fill = np.zeros(len(code), bool)
    fill[(starts[1:, None] - np.arange(1, N)).ravel()] = True
    keep = letter | fill
    keep[1:] |= letter[:-1]
    keep[starts[:-1]] = True
    at = np.flatnonzero(keep)
    code = np.concatenate((code[at], np.full(N, _SPACE, np.uint64)))
    h = code[:len(at)].copy()
    for k in range(1, N):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += code[k:k + len(at)]
    begins = ~fill[at]
    return mix(h[begins]), np.searchsorted(at[begins], starts), has_letter


def _slots_of(hashes: np.ndarray, slot_bits: int):
    low = np.uint64((1 << slot_bits) - 1)
    return [((hashes >> np.uint64(k * (64 - slot_bits) // max(1, HASHES - 1))) & low).astype(np.int64) for k in range(HASHES)]


def learn(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", where: Column | None = None,
          docs_per_lang: int = DOCS_PER_LANG, slot_bits: int = SLOT_BITS) -> Model:
    """Filters of all labels of the rows ``where`` holds (all, if not given)."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
                       (F.lit(True) if where is None else where).alias("ok"))
    rows = rows.where("ok and lang is not null and id is not null")
    counts = {r["lang"]: r["n"] for r in rows.where("text is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    words = max(1, -(-len(langs) // 64))
    if not langs:
        return Model([], np.zeros((words, 1 << slot_bits), np.uint8), np.zeros(0), 0, slot_bits)
    # a row for each language, of which the model holds a bit each
    numbered = docs.sparkSession.createDataFrame([(v, i, min(1.0, docs_per_lang / counts[v])) for i, v in enumerate(langs)], "known string, l int, part double")
    draw = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 30)) / float(1 << 30)
    numbered = F.broadcast(numbered) if len(langs) <= BROADCAST_LANGS else numbered
    sample = rows.join(numbered, F.col("lang") == F.col("known")).where(draw < F.col("part")).select("l", "text")
    seen = sample.mapInArrow(_count_grams, "l int, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n"))
    total = seen.groupBy("l").agg(F.sum("n").alias("total"))
    rate = seen.where(F.col("n") >= MIN_COUNT).join(F.broadcast(total), "l").withColumn("rate", F.col("n") / F.col("total"))
    best = rate.groupBy("g").agg(F.max("rate").alias("best"), F.collect_list(F.struct("l", "rate")).alias("in"))  # a row per language
    member = best.select("g", F.explode(F.filter("in", lambda x: x["rate"] >= SHARE * F.col("best"))).alias("x")).select("g", "x.l")
    member = keep_lineage(member)
    most = member.groupBy("l").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 1
    # a filter of s slots with n n-grams has 1 - exp(-HASHES n / s) of them set
    slot_bits = max(slot_bits, int(np.ceil(np.log2(HASHES * most / -np.log1p(-FILL)))))
    filled = member.mapInArrow(_fill(slot_bits), "s int, w int, m long").groupBy("s", "w").agg(F.bit_or("m").alias("m"))
    # at most 2**slot_bits rows for each 64 languages
    table = filled.toArrow()
    slots = np.zeros((words, 1 << slot_bits), np.uint64)
    slots[table["w"].to_numpy(), table["s"].to_numpy()] = table["m"].to_numpy().astype(np.int64).view(np.uint64)
    fill = np.array([((slots[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))])
    kind = np.min_scalar_type((1 << len(langs)) - 1) if len(langs) <= 64 else np.uint64
    usual = max(range(len(langs)), key=lambda i: (counts[langs[i]], -i))
    return Model(langs, slots.astype(kind), fill ** HASHES, usual, slot_bits)


def _count_grams(batches):
    for batch in batches:
        for lo, hi, _, _ in chunks(batch.column(1)):
            hashes, first, _ = grams(batch.column(1)[lo:hi].to_pylist())
            label = np.asarray(batch.column(0)[lo:hi])
            for l in np.unique(label):
                own = np.concatenate([hashes[first[i]:first[i + 1]] for i in np.flatnonzero(label == l)])
                g, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), l, np.int32)), pa.array(g.view(np.int64)),
                                                  pa.array(n.astype(np.int64))], names=["l", "g", "n"])


def _fill(slot_bits: int):
    def run(batches):
        for batch in batches:
            g = np.asarray(batch.column("g")).view(np.uint64) if batch.num_rows else np.zeros(0, np.uint64)
            lang = np.asarray(batch.column("l")).astype(np.int64)
            bit = (np.uint64(1) << (lang % 64).astype(np.uint64)).view(np.int64)
            for s in _slots_of(g, slot_bits):
                yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array((lang // 64).astype(np.int32)),
                                                  pa.array(bit)], names=["s", "w", "m"])
    return run


def decide(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1: corrected share of n-grams in the language) of each text."""
    hashes, first, has_letter = grams(texts)
    size = np.diff(first)
    if not model.langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    at = _slots_of(hashes, model.slot_bits)
    shares = np.zeros((len(model.langs), len(texts)))
    for w, table in enumerate(model.slots):
        mask = table[at[0]]
        for s in at[1:]:
            mask &= table[s]
        for l in range(w * 64, min(len(model.langs), w * 64 + 64)):
            hits = np.add.reduceat((mask >> mask.dtype.type(l % 64)) & mask.dtype.type(1), first[:-1], dtype=np.int64)
            false = model.false_rate[l]
            shares[l] = (hits - size * false) / np.maximum(size * (1 - false), 1e-9)
    shares = np.clip(shares, 0.0, 1.0)
    pick = np.where(shares.max(axis=0) > 0, shares.argmax(axis=0), model.usual)
    score = np.where(has_letter, shares.max(axis=0), 0.0)
    return [model.langs[p] if ok else "und" for p, ok in zip(pick.tolist(), has_letter.tolist())], score


def predict(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) plus lang_pred and score."""
    docs = cleared(docs, "lang_pred", "score")
    keep = docs.columns if keep is None else keep
    kept, at = [docs.columns.index(c) for c in keep], docs.columns.index(text)
    shared = share(docs, asdict(model))

    def run(batches):
        own = Model(**shared.value)
        for batch in batches:
            column, langs, scores = batch.column(at), [], []
            for lo, hi, _, _ in chunks(column, 1 << 18):
                found, score = decide(column[lo:hi].to_pylist(), own)
                langs += found
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(langs, pa.string()),
                                              pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=[*keep, "lang_pred", "score"])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[k] for k in kept), T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType())]))
