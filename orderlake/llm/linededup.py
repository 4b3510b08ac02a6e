"""Cross-site line dedup by distinct-site spread (DataFrame functions only).

A line's spread is the number of distinct sites whose documents hold it. A
HyperLogLog sketch of the sites is kept per line hash; sketches merge map-side, so
a line that a third of all documents share is one row per task before the
shuffle. Lines whose estimate lies so close to the threshold that the sketch's
error could decide get an exact distinct count; the others are judged by estimate.

A line seen on ``min_sites`` sites or more is boilerplate: it stays in the first
document that has it (smallest id, then text hash, then position) and goes from
everywhere else, so a passage is never lost altogether.

Lines are compared without blanks at either end and by 128 bits of hash. Blank lines
never go. Defined results: a null text has no lines and stays null; a null site is a site of its
own; a null id comes after all others; rows equal in id and text are one document
and keep the same lines; line order stays. Empty tables give empty results. Extra
columns pass through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import fresh, keep_lineage, let, cleared, row_key

MIN_SITES = 3
#: Sketch size as a power of two, and how many standard errors count as near the threshold.
LG_K = 12
ERRORS = 4.0
#: Most lines of some 70 bytes that are broadcast to the documents' lines.
BROADCAST_LINES = 200_000


def _line_rows(keyed: DataFrame, doc_id: str, text: str, site: str, k1: str, k2: str) -> DataFrame:
    """One narrow row per non-blank line: h1, h2 of the line, site hash, and where it stands."""
    lines = keyed.select(F.col(doc_id).alias("id"), F.xxhash64(F.lit(3), F.col(site)).alias("site"),
                         F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    lines = lines.withColumn("line", F.btrim("line", F.lit(" \t\r"))).where("line != ''")
    return lines.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), "site", "id", "k1", "k2", "pos")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first) of the lines on at least ``min_sites`` distinct sites; first: where the line stays."""
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "k1", "k2", "pos")
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.min(place).alias("first"))
    # relative error of a sketch of 2**lg_k registers
    margin = ERRORS * 1.04 / (2 ** lg_k) ** 0.5
    low, high = min_sites * (1 - margin) - 0.5, min_sites * (1 + margin) + 0.5
    # hll_sketch_estimate rounds to whole sites, hence the half
    guess = spread.select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low)
    guess = keep_lineage(guess)
    near = guess.where(F.col("sites") <= high)
    exact = (lines.select("h1", "h2", "site").join(_small(near.select("h1", "h2")), ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.count_distinct("site").alias("exact")).where(F.col("exact") >= min_sites))
    sure = guess.where(F.col("sites") > high).select("h1", "h2", "first")
    return sure.unionByName(near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def _small(few: DataFrame) -> DataFrame:
    """Lines of a checkpointed frame: broadcast when they are few enough, else left to a shuffle that splits hot lines."""
    return F.broadcast(few) if few.count() <= BROADCAST_LINES else few


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with cross-site lines taken out of the text, plus n_lines, n_removed (longs) and
    removed_lines (their positions from 0, ascending)."""
    docs = cleared(docs, "n_lines", "n_removed", "removed_lines")
    k1, k2, gone = fresh(docs, "_k1", "_k2", "_gone")
    keyed = docs.withColumns(dict(zip((k1, k2), row_key(F.col(doc_id), F.col(text)))))
    lines = _line_rows(keyed, doc_id, text, site, k1, k2)
    found = keep_lineage(boilerplate(lines, min_sites))
    stays = (F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2")) & (F.col("first.pos") == F.col("pos"))
    removed = lines.join(_small(found), ["h1", "h2"]).where(~stays).groupBy("k1", "k2") \
                   .agg(F.collect_set("pos").alias(gone)).select(F.col("k1").alias(k1), F.col("k2").alias(k2), gone)
    all_lines = F.split(F.col(text), "\n")
    # positions left are a set difference, so a text of many lines takes one pass
    cleaned = let(all_lines, lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(gone)), lambda i: F.get(ls, i)), "\n"))
    joined = keyed.join(removed, [k1, k2], "left")
    done = joined.select(
        *[F.when(F.col(gone).isNull(), F.col(c)).otherwise(cleaned).alias(c) if c == text else F.col(c) for c in docs.columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(all_lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_sort(gone), F.array().cast("array<int>")).alias("removed_lines"))
    return done
