"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and calls one operator.

What the stage before broadcast is dropped first: its result is written by then.
All but the last return exactly the columns they were given, n_chars renewed where a stage edits texts.
Columns beyond those of ``documents`` may have any name: a stage sets them aside and puts them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import decontam, langid, linededup, mixing, simhash
from orderlake.llm.frames import release, shield, word_count

USED = ("doc_id", "text", "lang", "source", "n_chars")
#: Least share of a text's n-grams that its language must hold.
MIN_SCORE = 0.5


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars``, if there, as the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those whose text fits no learned language, go. Learns from all labelled rows.

    Null, empty and blank texts go; rows with a null id or lang are not learned from but judged; repeated rows are judged each on
    its own; without a labelled row, and from an empty table, nothing stays.
    """
    release()
    plain, restore = shield(docs, *USED)
    found = langid.predict(plain, langid.learn(plain))
    return restore(found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines seen on several sites go from all documents but the first; a document they made up altogether goes too.

    A null text stays null and its document stays; a null source is a site of its own; repeated rows are documents of one site;
    an empty table gives an empty one.
    """
    release()
    plain, restore = shield(docs, *USED)
    done = linededup.dedup_lines(plain)
    return restore(_measured(done).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: that of the smallest doc_id.

    Null, empty and blank texts are one group; null ids come last; repeated rows are one; an empty table gives an empty one.
    """
    release()
    plain, restore = shield(docs, *USED)
    return restore(simhash.keep_one(plain))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is half benchmark or more goes.

    Null and wordless texts are clean and stay; repeated rows are judged each on its own; null or wordless items count for nothing; an
    empty benchmark changes nothing, an empty table gives an empty one.
    """
    release()
    plain, restore = shield(docs, *USED)
    return restore(_measured(decontam.clean(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (copies), their words (size), the words taken and
    their source's size and target. These replace columns of the same names.

    Null and blank texts have size 0 and may be taken; a null source is a source of its own; null ids and repeated rows are
    separate documents; an empty table gives an empty mix.
    """
    release()
    sized = docs.drop("size").withColumn("size", word_count(F.col("text")))
    return mixing.mix(sized, size="size", text="text").where("copies > 0")
