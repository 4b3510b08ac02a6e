"""Benchmark decontamination: broadcast hash set of normalised test n-grams.

Every window of ``n`` consecutive benchmark words (a shorter item is one window
of its own length) enters a sorted array of 64-bit hashes. Each document's words
are hashed once, rolling window hashes are looked up in that set, and every hit is
verified word by word against the benchmark text before it counts.

The set is broadcast only in blocks of at most ``block_words`` benchmark words.
A larger benchmark is scanned in several passes, one block each, and the passes'
hits are merged per document; the result is the same.

Defined results: a null or empty text has no words and is clean; a null or
wordless item has no window; items that share an id count once; a null item id is
reported as ``null``; rows that repeat are judged each on its own; empty tables
give empty or all-clean results. Extra document columns pass through; a column
named like a result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm import vectext
from orderlake.llm.frames import cleared, fresh, keep_lineage, row_key, share

#: Words are runs of digits, a-z and everything beyond ASCII, after A-Z were lower-cased.
_DELIMITERS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
WINDOW = 10
#: Words of benchmark text in one broadcast block: about 40 MB of arrays.
BLOCK_WORDS = 1_000_000
#: The windows of no items.
NOTHING = {"ids": [], "words": [], "sets": {}}

_SPAN = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType(), False),
                                  T.StructField("end_word", T.LongType(), False)]), False)
_SPAN_ARROW = pa.list_(pa.struct([pa.field("first_word", pa.int64(), False), pa.field("end_word", pa.int64(), False)]))


def _is_word() -> np.ndarray:
    return vectext.byte_class(_DELIMITERS)


def window_set(items: list[tuple[str, str]], n: int) -> dict:
    """Windows of one block of items as plain data: ``ids``, ``words`` (normalised, of all items in turn) and, by
    window length, sorted hashes with the first word and item of each and a table of the hashes' leading bits."""
    is_word = _is_word()
    ids = sorted({i for i, _ in items})
    number = {x: k for k, x in enumerate(ids)}
    by_length: dict[int, list] = {}
    words: list[bytes] = []
    for lo, _, data, offsets in vectext.chunks(pa.array([t for _, t in items], pa.string())):
        data = vectext.lowered(data)
        starts, ends, hashes, first = vectext.words(data, offsets, is_word)
        raw, base = data.tobytes(), len(words)
        words += [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        for k in range(len(offsets) - 1):
            a, b = int(first[k]), int(first[k + 1])
            if b > a:
                length = min(n, b - a)
                at = np.arange(a, b - length + 1)
                by_length.setdefault(length, []).append(
                    (vectext.rolling(hashes[a:b], length), at + base, np.full(len(at), number[items[lo + k][0]])))
    sets = {}
    for length, parts in sorted(by_length.items()):
        h, at, item = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.argsort(h, kind="stable")
        bits = max(16, int(len(h) * 64).bit_length())
        seen = np.zeros(1 << bits, bool)
        seen[h >> np.uint64(64 - bits)] = True
        sets[length] = (h[order], at[order], item[order], bits, seen)
    return {"ids": ids, "words": words, "sets": sets}


def _hits(windows: dict, raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, row_of: np.ndarray):
    """(word index, length, item number) of every window of a chunk that is in the set, verified word by word."""
    words = windows["words"]
    for length, (known, at, item, bits, seen) in windows["sets"].items():
        rolled = vectext.rolling(hashes, length)
        if not len(rolled):
            continue
        maybe = np.flatnonzero(seen[rolled >> np.uint64(64 - bits)])
        maybe = maybe[row_of[maybe] == row_of[maybe + length - 1]]
        left, right = np.searchsorted(known, rolled[maybe], "left"), np.searchsorted(known, rolled[maybe], "right")
        here = np.flatnonzero(right > left)
        for w, a, b in zip(maybe[here].tolist(), left[here].tolist(), right[here].tolist()):
            own = [raw[s:e] for s, e in zip(starts[w:w + length].tolist(), ends[w:w + length].tolist())]
            for k in {int(item[k]) for k in range(a, b) if words[at[k]:at[k] + length] == own}:
                yield w, length, k


def _scan_texts(column: pa.Array, windows: dict) -> Iterator[tuple[int, list[tuple[int, int]], list[str], bytes, np.ndarray, np.ndarray]]:
    """Per row: number of words, merged hit spans in words, item ids, and the lowered bytes with word starts and ends."""
    is_word = _is_word()
    for _, _, data, offsets in vectext.chunks(column):
        low = vectext.lowered(data)
        starts, ends, hashes, first = vectext.words(low, offsets, is_word)
        row_of = np.searchsorted(first, np.arange(len(starts)), "right") - 1
        covered = np.zeros(len(starts) + 1, np.int32)
        items: dict[int, set[int]] = {}
        for w, length, item in _hits(windows, low.tobytes(), starts, ends, hashes, row_of):
            covered[w] += 1
            covered[w + length] -= 1
            items.setdefault(int(row_of[w]), set()).add(item)
        hit = np.cumsum(covered[:-1]) > 0
        for r in range(len(offsets) - 1):
            a, b = int(first[r]), int(first[r + 1])
            spans = []
            if r in items:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0]))))
                spans = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
            base = int(offsets[r])
            yield (b - a, spans, sorted(windows["ids"][i] for i in items.get(r, ())),
                   data[base:int(offsets[r + 1])], starts[a:b] - base, ends[a:b] - base)


def _without(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> str:
    """The text without the bytes of the spans' words; what stood around a span is joined by a line break."""
    raw, at, kept = text.tobytes(), 0, []
    for a, b in spans:
        kept.append(raw[at:int(starts[a])])
        at = int(ends[b - 1])
    kept.append(raw[at:])
    return b"\n".join(kept).decode("utf-8", "replace")


def _blocks(bench: DataFrame, item_id: str, text: str, block_words: int) -> list[DataFrame]:
    """The items (id, text), each once, in frames of about ``block_words`` words."""
    rows = bench.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.col(text).alias("text")) \
                .where(F.col("text").isNotNull() & (F.col("text") != "")).distinct()
    # at most one word for every two bytes, so bytes bound the words
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    n = max(1, -(-int(size) // (2 * block_words)))
    return [rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)]


def _windows_of(block: DataFrame, n: int) -> dict:
    return window_set([(r["id"], r["text"]) for r in block.collect()], n)


def scan(docs: DataFrame, bench: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         n: int = WINDOW, block_words: int = BLOCK_WORDS, drop_text: bool = False) -> DataFrame:
    """``docs`` plus n_words, n_hit, hit_spans (first and end word of each merged run) and hit_items (sorted ids).

    ``drop_text`` leaves the text out, which spares sending it back from the scan.
    """
    added = ("n_words", "n_hit", "hit_spans", "hit_items")
    docs = cleared(docs, *added)
    blocks = _blocks(bench, item_id, item_text, block_words)
    if len(blocks) == 1:
        return _one_pass(docs, text, share(docs, _windows_of(blocks[0], n)), drop_text)
    h1, h2 = fresh(docs, "_h1", "_h2")
    keyed = docs.withColumns(dict(zip((h1, h2), row_key(F.lit(0), F.col(text)))))
    found = _found(keyed.select(F.col(h1).alias("h1"), F.col(h2).alias("h2"), F.col(text).alias("text")), blocks, n, drop_text=True)
    # equal texts have equal hits
    hits = _united(found, "h1", "h2").withColumnsRenamed({"h1": h1, "h2": h2})
    counted = _one_pass(keyed, text, share(docs, NOTHING), drop_text).drop("n_hit", "hit_spans", "hit_items")
    return counted.join(hits, [h1, h2], "left").select(
        *(c for c in docs.columns if not (drop_text and c == text)), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("hit_spans", F.array().cast(_SPAN)).alias("hit_spans"),
        F.coalesce("hit_items", F.array().cast("array<string>")).alias("hit_items"))


def _one_pass(docs: DataFrame, text: str, shared: Broadcast, drop_text: bool = False) -> DataFrame:
    at = docs.columns.index(text)
    kept = [k for k in range(len(docs.columns)) if not (drop_text and k == at)]
    schema = T.StructType([*(docs.schema[k] for k in kept), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                           T.StructField("hit_spans", _SPAN), T.StructField("hit_items", T.ArrayType(T.StringType(), False))])

    def run(batches):
        for batch in batches:
            found = [x[:3] for x in _scan_texts(batch.column(at), shared.value)]
            spans = [[{"first_word": a, "end_word": b} for a, b in s] for _, s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([sum(b - a for a, b in f[1]) for f in found], pa.int64()),
                 pa.array(spans, _SPAN_ARROW), pa.array([f[2] for f in found], pa.list_(pa.string()))],
                names=[*(batch.schema.names[k] for k in kept), "n_words", "n_hit", "hit_spans", "hit_items"])

    return docs.mapInArrow(run, schema)


def _united(found: DataFrame, h1: str, h2: str) -> DataFrame:
    """n_hit, hit_spans and hit_items of each key, from ``found`` with a row for each key and block."""
    word = (found.select(h1, h2, F.explode("hit_spans").alias("s"))
            .select(h1, h2, F.explode(F.sequence("s.first_word", F.expr("s.end_word - 1"))).alias("w")).distinct()
            .groupBy(h1, h2).agg(F.sort_array(F.collect_list("w")).alias("w")))
    runs = F.expr("""aggregate(w, cast(array() as array<struct<first_word:bigint,end_word:bigint>>), (acc, x) ->
        if(size(acc) > 0 and element_at(acc, -1).end_word = x,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('first_word', element_at(acc, -1).first_word, 'end_word', x + 1))),
           concat(acc, array(named_struct('first_word', x, 'end_word', x + 1)))))""")
    items = (found.select(h1, h2, F.explode("hit_items").alias("i")).distinct()
             .groupBy(h1, h2).agg(F.sort_array(F.collect_list("i")).alias("hit_items")))
    return word.select(h1, h2, F.size("w").cast("long").alias("n_hit"), runs.alias("hit_spans")).join(items, [h1, h2])


def _found(texts: DataFrame, blocks: list[DataFrame], n: int, drop_text: bool = False) -> DataFrame:
    """The rows of ``texts`` (h1, h2, text and more) that some block hits, one of each key, with n_words and that block's
    hit_spans and hit_items. Blocks go one by one: a block's hits are stored and its windows dropped before the next."""
    found = None
    for block in blocks:
        shared = texts.sparkSession.sparkContext.broadcast(_windows_of(block, n))
        one = keep_lineage(_one_pass(texts, "text", shared, drop_text).where("n_hit > 0").drop("n_hit").dropDuplicates(["h1", "h2"]))
        shared.destroy()
        found = one if found is None else found.unionByName(one)
    return found


def clean(docs: DataFrame, bench: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          n: int = WINDOW, drop_share: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without benchmark passages: hit words are cut out of the text, and a document goes
    whole when at least ``drop_share`` of its words are hit. A cut text is scanned again until nothing
    is found, so no passage survives as two halves. Untouched documents come back as they were.
    The result is the same for any ``block_words``: what is cut are the hits of all blocks together.
    """
    blocks = _blocks(bench, item_id, item_text, block_words)
    if len(blocks) == 1:
        return _clean_pass(docs, text, _windows_of(blocks[0], n), drop_share)
    return _clean_rounds(docs, text, blocks, n, drop_share)


def _clean_rounds(docs: DataFrame, text: str, blocks: list[DataFrame], n: int, drop_share: float) -> DataFrame:
    """Rounds over the texts that the round before changed, until no block hits any; equal texts are cut once."""
    h1, h2, new = fresh(docs, "_h1", "_h2", "_new")
    keyed = docs.withColumns(dict(zip((h1, h2), row_key(F.lit(0), F.col(text)))))
    todo = keyed.select(F.col(h1).alias("h1"), F.col(h2).alias("h2"), F.col(text).alias("text"),
                        F.lit(None).cast("long").alias("words"), F.lit(0).cast("long").alias("removed"))
    changed, k = None, 0
    while k == 0 or not todo.isEmpty():
        cut = keep_lineage(_cut(_found(todo, blocks, n), drop_share))
        todo, k = cut.where("text is not null"), k + 1
        one = cut.select("h1", "h2", F.struct(F.lit(k).alias("k"), "text").alias("last"))
        changed = one if changed is None else changed.unionByName(one)
    # of each key the text of its last round, null if the document goes
    last = changed.groupBy(F.col("h1").alias(h1), F.col("h2").alias(h2)).agg(F.max("last").alias(new))
    return keyed.join(last, [h1, h2], "left").where(F.col(new).isNull() | F.col(new)["text"].isNotNull()).select(
        *(F.when(F.col(new).isNull(), F.col(c)).otherwise(F.col(new)["text"]).alias(c) if c == text else F.col(c) for c in docs.columns))


def _cut(found: DataFrame, drop_share: float) -> DataFrame:
    """One row of each key of ``found`` with the hits of all blocks cut out of its text, which is null where
    ``drop_share`` of the original words is reached."""
    rows = found.select("h1", "h2", "text", F.coalesce("words", "n_words").alias("words"), "removed").dropDuplicates(["h1", "h2"])
    rows = rows.join(_united(found, "h1", "h2").drop("hit_items"), ["h1", "h2"]).withColumn("removed", F.col("removed") + F.col("n_hit"))
    rows = rows.select("h1", "h2", "text", "words", "removed", "hit_spans")

    def run(batches):
        for batch in batches:
            total, gone, spans = (batch.column(k).to_pylist() for k in (3, 4, 5))
            texts = [None if gone[r] >= drop_share * total[r] else
                     _without(body, starts, ends, [(s["first_word"], s["end_word"]) for s in spans[r]])
                     for r, (_, _, _, body, starts, ends) in enumerate(_scan_texts(batch.column(2), NOTHING))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              batch.column(3), batch.column(4)], names=["h1", "h2", "text", "words", "removed"])

    return rows.mapInArrow(run, "h1 long, h2 long, text string, words long, removed long")


def _clean_pass(docs: DataFrame, text: str, windows: dict, drop_share: float) -> DataFrame:
    shared = share(docs, windows)
    at = docs.columns.index(text)

    def cut(original: str | None, body, starts, ends, spans, words):
        removed = 0
        while spans:
            removed += sum(b - a for a, b in spans)
            if removed >= drop_share * words:
                return None
            original = _without(body, starts, ends, spans)
            _, spans, _, body, starts, ends = next(_scan_texts(pa.array([original], pa.string()), shared.value))
        return original

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            keep, changed = np.ones(len(column), bool), {}
            for r, (words, spans, _, body, starts, ends) in enumerate(_scan_texts(column, shared.value)):
                if spans:
                    changed[r] = cut(None, body, starts, ends, spans, words)
                    keep[r] = changed[r] is not None
            if changed:
                texts = column.to_pylist()
                for r, new in changed.items():
                    texts[r] = new
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type)).filter(pa.array(keep))
            yield batch

    return docs.mapInArrow(run, docs.schema)
