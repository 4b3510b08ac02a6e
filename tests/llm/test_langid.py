"""Language identification: held-out accuracy and the filter itself."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from orderlake.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_on_the_whole_table(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op7_language"](spark, SF).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert np.mean(held) >= 0.97


def test_grams_are_those_of_each_text_alone():
    texts = ["Zu und.", None, "", "a--b", "ÄÖ 12 ü", "x" * 50]
    hashes, first, has = langid.grams(texts)
    assert has.tolist() == [True, False, False, True, True, True]
    for k, t in enumerate(texts):
        alone, cut, _ = langid.grams([t])
        assert hashes[first[k]:first[k + 1]].tolist() == alone[:cut[1]].tolist()
    same = langid.grams(["zu, und"])[0].tolist()
    assert langid.grams(["ZU und"])[0].tolist() == same


def model(spark, rows):
    return langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), slot_bits=14)


def test_masks_name_all_languages_of_an_ngram_and_more_than_64_fit(spark):
    rows = [(k, f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}uv shared words here " * 4, f"l{k:02d}") for k in range(70)]
    m = model(spark, rows)
    assert len(m.langs) == 70 and m.slots.shape[0] == 2
    texts = [t for _, t, _ in rows]
    langs, score = langid.decide(texts, m)
    assert langs == [x for _, _, x in rows] and score.min() > 0.9
    assert langid.decide(["shared words here"], m)[1][0] > 0.5


def test_defined_results_of_texts_without_a_clue(spark):
    m = model(spark, [(1, "the river and the stone", "en"), (2, "the river and the cloud", "en"), (3, "der fluss und der stein", "de"),
                      (None, "zzz", "xx"), (4, None, "yy"), (5, "qqq", None)])
    assert m.langs == ["de", "en"]
    langs, score = langid.decide([None, "", "12 !", "жжжжжж", "the river"], m)
    assert langs == ["und", "und", "und", "en", "en"] and score[:4].tolist() == [0, 0, 0, 0]
    empty = model(spark, [(1, None, None)])
    assert langid.decide(["the river", None], empty)[0] == ["und", "und"]


def test_awkward_rows(spark, awkward, nothing):
    m = langid.learn(awkward)
    got = langid.predict(awkward, m)
    assert got.count() == awkward.count() and {r.lang_pred for r in got.where("text is null").collect()} == {"und"}
    assert "score" in got.columns and got.schema["score"].dataType.typeName() == "double"
    assert langid.predict(nothing, langid.learn(nothing)).collect() == []
    assert got.where(F.col("lang_pred").isNull()).count() == 0
