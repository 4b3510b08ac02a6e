"""Source divergence audit: how far the word frequencies of each source stand from those of others.

*Counting* is an Arrow pipeline inside ``mapInArrow``: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode``
and a hash ``group_by`` turn each batch into partial counts (language, source, term, occurrences, documents), which Spark
adds up. *Divergences* are taken on columnar shards: the counts, dealt by language and term so that all sources of a
term lie together and no language is one task, fill matrices of terms by sources, and every shard gives partial sums for
each pair of sources and its best terms for each source.

Each language keeps the terms that stand in at least ``least_docs`` of its documents. With count c of N (over kept terms)
and V kept terms a term's share is ``p = 1 + floor(UNIT (c + 1) / (N + V))``, and one share differs from another by
``f = floor((p - q)^2 / q)``, all in whole numbers. N and V up to 9e15 / 1000 stay exact in 64 bits.

Result, a row per (lang, source, part, item): part ``pair``, every other source of the language with the sum of f over
all kept terms; part ``term``, up to ``top`` kept terms that the source uses more than its language does, with f.
``rank`` counts from 1 in each part by falling value, then by the item's bytes.

Defined results: null text, language or source are the empty string; a group without kept terms has share
``1 + floor(UNIT / V)`` for each; a language without kept terms has value 0 for all pairs. Rows that repeat count each;
an empty table gives an empty result; other columns are not read. Long texts are split in pieces that end at
a delimiter, and a term counts once for each document all the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.frames import keep_lineage, share
from orderlake.llm.vectext import byte_class, chunks

UNIT = 1_000_000_000
LEAST_DOCS = 3
TOP = 200
#: Bytes of text counted at a time, and cells of a shard's matrix.
COUNTED, CELLS = 4 << 20, 1 << 20
#: Groups (language, source) whose sizes are broadcast; more go by a join.
GROUPS = 20_000

_DELIMITERS = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_COUNTS = "lang string, source string, term string, n long, docs long"


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, end row, texts) of about ``COUNTED`` bytes; a longer text gives several pieces, cut at delimiters."""
    between = byte_class(_DELIMITERS) == 0
    for lo, hi, data, offsets in chunks(column, COUNTED):
        if hi - lo > 1 or len(data) <= COUNTED:
            yield lo, hi, column.slice(lo, hi - lo)
            continue
        a = 0
        while a < len(data):
            b = min(a + COUNTED, len(data))
            while b < len(data):
                gap = np.flatnonzero(between[data[b:b + COUNTED]])
                if len(gap):
                    b += int(gap[0])
                    break
                b = min(b + COUNTED, len(data))
            yield lo, hi, pa.array([data[a:b].tobytes()], pa.binary()).cast(pa.string())
            a = b


def _terms(texts: pa.Array, first: int) -> pa.Table:
    """(row, term, n) of some rows, the first of them row ``first``."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=_BETWEEN)
    rows, terms = pc.add(pc.list_parent_indices(lists).cast(pa.int64()), first), pc.list_flatten(lists)
    some = pc.not_equal(pc.binary_length(terms), 0)
    coded = terms.filter(some).dictionary_encode()
    table = pa.table({"row": rows.filter(some), "code": coded.indices})
    counted = table.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    return pa.table({"row": counted["row"], "term": coded.dictionary.take(counted["code"].combine_chunks()), "n": counted["count_all"]})


def _batch_counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Partial counts of a batch with the columns lang, source, text."""
    lang, source, text = (batch.column(k) for k in range(3))
    waiting: list[pa.Table] = []

    def counts(tables: list[pa.Table]) -> pa.RecordBatch:
        found = pa.concat_tables(tables)
        if len(tables) > 1:  # pieces of one text
            found = found.group_by(["row", "term"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["row", "term", "n"])
        rows = found["row"].combine_chunks()
        table = pa.table({"lang": lang.take(rows), "source": source.take(rows), "term": found["term"], "n": found["n"]})
        grouped = table.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
        grouped = grouped.select(["lang", "source", "term", "n_sum", "count_all"]).rename_columns(["lang", "source", "term", "n", "docs"])
        return grouped.combine_chunks().to_batches()

    at = -1
    for lo, hi, texts in _pieces(text):
        if waiting and lo != at:
            yield from counts(waiting)
            waiting = []
        at = lo
        waiting.append(_terms(texts, lo))
    if waiting:
        yield from counts(waiting)


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and how many of its documents hold it."""
    rows = docs.select(_text(F.col(lang)).alias("lang"), _text(F.col(source)).alias("source"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            yield from _batch_counts(batch)

    partial = rows.mapInArrow(run, _COUNTS)
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def proportion(count: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """``1 + floor(UNIT (count + 1) / (total + kept))``, a thousandth at a time so that nothing overflows."""
    whole = np.asarray(total + kept, np.int64)
    rest = count.astype(np.int64) + 1
    out = np.zeros(np.broadcast(rest, whole).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _block(lang: str, sources: dict[str, int], totals: np.ndarray, kept: int, terms: list[str], rows: np.ndarray,
           columns: np.ndarray, counts: np.ndarray, top: int) -> pa.RecordBatch:
    """Partial results of some terms of a language: sums for each pair of its sources, best terms for each source."""
    names = list(sources)
    table = np.zeros((len(terms), len(names)), np.int64)
    table[rows, columns] = counts
    p = proportion(table, totals[None, :], kept)
    q = proportion(table.sum(axis=1), int(totals.sum()), kept)
    out: list[tuple] = []
    for k, name in enumerate(names):
        sums = _differ(p[:, k:k + 1], p).sum(axis=0)
        out += [(lang, name, "pair", other, int(v)) for j, (other, v) in enumerate(zip(names, sums)) if j != k]
        more = np.flatnonzero((table[:, k] > 0) & (p[:, k] > q))
        value = _differ(p[more, k], q[more])
        # terms come in the order of their bytes, which settles ties
        best = np.argsort(-value, kind="stable")[:top]
        out += [(lang, name, "term", terms[t], int(v)) for t, v in zip(more[best].tolist(), value[best].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
        zip(*out) if out else [[]] * 5, [pa.string()] * 4 + [pa.int64()])], names=["lang", "source", "part", "item", "value"])


def _shards(batches: Iterator[pa.RecordBatch], groups: dict[str, tuple[dict[str, int], list[int], int]], top: int) -> Iterator[pa.RecordBatch]:
    """Batches (lang, term, source, n), sorted by language and term, to partial results, whole terms at a time."""
    lang, terms, rows, columns, counts = None, [], [], [], []

    def done():
        sources, totals, kept = groups[lang]
        return _block(lang, sources, np.array(totals, np.int64), kept, terms, np.array(rows), np.array(columns), np.array(counts, np.int64), top)

    for batch in batches:
        for la, term, source, n in zip(*(c.to_pylist() for c in batch.columns)):
            if la != lang or (terms and term != terms[-1] and len(terms) * len(groups[la][0]) >= CELLS):
                if terms:
                    yield done()
                lang, terms, rows, columns, counts = la, [], [], [], []
            if not terms or term != terms[-1]:
                terms.append(term)
            rows.append(len(terms) - 1)
            columns.append(groups[la][0][source])
            counts.append(n)
    if terms:
        yield done()


def _by_rows(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The partial results by joins alone, where there are too many groups to broadcast."""
    part = "1 + (cast(1000000000 as decimal(20,0)) * ({0} + 1)) div ({1} + {2})"
    in_lang = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    terms = kept.groupBy("lang", "term").agg(F.sum("n").alias("c"))
    filled = (terms.join(groups, "lang").join(in_lang, "lang").join(kept, ["lang", "term", "source"], "left")
              .selectExpr("lang", "source", "term", "coalesce(n, 0) as n", part.format("coalesce(n, 0)", "total", "kept") + " as p",
                          part.format("c", "all", "kept") + " as q"))
    other = filled.selectExpr("lang", "term", "source as item", "p as r")
    pairs = (filled.join(other, ["lang", "term"]).where("source != item").groupBy("lang", "source", "item")
             .agg(F.sum(F.expr("(p - r) * (p - r) div r")).alias("value")).selectExpr("lang", "source", "'pair' as part", "item", "value"))
    more = filled.where("n > 0 and p > q").selectExpr("lang", "source", "'term' as part", "term as item", "(p - q) * (p - q) div q as value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.unionByName(more.withColumn("place", place).where(F.col("place") <= top).drop("place"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
          least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group; see the module."""
    in_lang = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = keep_lineage(term_counts(docs, text=text, lang=lang, source=source).withColumn("docs", in_lang)
                        .where(F.col("docs") >= least_docs).select("lang", "term", "source", "n"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = kept.groupBy("lang").agg(F.count_distinct("term").alias("kept"))
    groups = keep_lineage(docs.select(_text(F.col(lang)).alias("lang"), _text(F.col(source)).alias("source")).distinct()
                          .join(sizes, ["lang", "source"], "left").join(vocabulary, "lang", "left")
                          .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")))
    if groups.count() > GROUPS:
        partial = _by_rows(kept, groups, top)
    else:
        known: dict[str, tuple[dict[str, int], list[int], int]] = {}
        for r in sorted(groups.collect()):
            sources, totals, _ = known.setdefault(r["lang"], ({}, [], r["kept"]))
            sources[r["source"]] = len(sources)
            totals.append(r["total"])
        shared = share(docs, known)

        def run(batches):
            return _shards(batches, shared.value, top)

        # a term's rows lie together, a language's do not
        dealt = kept.repartition("lang", "term").sortWithinPartitions("lang", "term")
        partial = dealt.mapInArrow(run, "lang string, source string, part string, item string, value long")
    partial = keep_lineage(partial)
    names = groups.select("lang", "source", "kept")
    pairs = (names.join(names.select("lang", F.col("source").alias("item")), "lang").where(F.col("source") != F.col("item"))
             .join(partial.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")),
                   ["lang", "source", "item"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")))
    # first the best of parts of a group's terms, so that no task gets what all shards offer for one group
    some = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(8))).orderBy(F.desc("value"), "item")
    best = partial.where("part = 'term'").withColumn("place", F.row_number().over(some)).where(F.col("place") <= top).drop("place")
    by_rank = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (pairs.unionByName(best).withColumn("rank", F.row_number().over(by_rank))
            .where((F.col("part") == "pair") | (F.col("rank") <= top)))
