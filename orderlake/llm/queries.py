"""Registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import bpe, chat, decontam, divergence, langid, linededup, mixing, periodic, pii, quality, simhash, toxicity, winnow
from orderlake.llm.frames import BLANK_CLASS, documents, let, word_count
from orderlake.llm.oracles import ORACLE_SQL  # noqa: F401


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = documents(spark, sf_dir).select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(sized, size="size").select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [F.size(pii.of_kinds(F.col("spans"), (k,))).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined(pii.of_kinds(F.col("spans"), pii.BASE)), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ratio = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    scored = quality.score(hashed, ratio, keep=["doc_id", "text_hash"])
    return quality.gumbel_top_k(scored, order=["doc_id", "text_hash"]).select("doc_id", "n_grams", "log_ratio", "gumbel_key", "selected")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return done.select("doc_id", "n_lines", "n_removed", F.array_join("removed_lines", ",").alias("removed_lines"),
                       F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    masks = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return views.select("conv_id", "piece", "participant", "n_turns", "n_own", F.length("rendered").cast("long").alias("n_chars"),
                        F.sha2("rendered", 256).alias("rendered_sha256"), masks.alias("masks"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    model = langid.learn(docs, where=fold != 1)
    found = langid.predict(docs.drop("lang"), model, keep=["doc_id"])
    return found.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_with_next(documents(spark, sf_dir).select("doc_id", "text"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.scan(documents(spark, sf_dir).select("doc_id", "text"), bench, drop_text=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return toxicity.score(docs, toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), keep=["doc_id"])


def op11_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    tables = bpe.read(tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    coded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), tables, back="decoded", drop_text=True)
    return coded.select("doc_id", bpe.n_tokens().alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"),
                                            F.sha2("decoded", 256).alias("decoded_sha256"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one text in ten, by crc32 of its id, made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def planted(words):
        n = F.size(words)
        g = F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return let(a, lambda a: let(p, lambda p: F.array_join(F.transform(
            F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")))

    words = F.filter(F.split("text", BLANK_CLASS), lambda w: w != "")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]"), let(words, planted)).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(repeated(documents(spark, sf_dir).select("doc_id", "text")), drop_text=True)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return found.withColumn("m", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("m.s")).alias("start"), F.col("m.length").alias("length"),
        (-F.col("m.p")).alias("period"), F.floor(F.col("m.length") * 1000 / -F.col("m.p")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_source_mix, op2_pii, op3_quality, op4_line_dedup, op5_perspectives, op6_simhash, op7_language, op8_winnow, op9_decontaminate, op10_toxicity,
                              op11_bpe, op12_periodic, op13_divergence)
}
