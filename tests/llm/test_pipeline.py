"""The pipeline's stages on awkward rows and on a whole table, each against what it promises."""

import corpus_pipeline
from orderlake.llm import decontam, langid, stages
from tests.llm.conftest import prose
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_simhash import brute_classes, brute_print

SF = "/root/testdata/sf0.001"


def test_stages_on_awkward_rows_keep_their_columns(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            assert out.count() <= docs.count()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert set(docs.columns) - {"taken", "size"} <= set(last.columns) and last.count() <= docs.count()


def test_each_stage_does_its_part_on_a_whole_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert set(kept[name]) <= set(before)
        after = kept[name]
        if name == "language":
            gone = [before[i].text for i in set(before) - set(after)]
            model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
            assert all(x < stages.MIN_SCORE for x in langid.decide(gone, model)[1]) if gone else True
        elif name == "lines":
            sites = {}
            for r in after.values():
                for line in {x.strip(" \t\r") for x in r.text.split("\n")}:
                    sites.setdefault(line, set()).add(r.source)
            assert max(len(s) for line, s in sites.items() if line) < 3
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_duplicates":
            prints = {i: brute_print(r.text) for i, r in before.items()}
            top = brute_classes(set(prints.values()))
            first = {}
            for i in sorted(prints):
                first.setdefault(top[prints[i]], i)
            assert set(after) == set(first.values())
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert all(brute_hits(r.text, items)[1] == 0 for r in after.values())
            assert all(after[i].text == r.text for i, r in before.items() if brute_hits(r.text, items)[1] == 0)
        else:
            assert all(r.copies in (1, 2) and r.taken == r.copies * r.size for r in after.values())
            total = sum(len(r.text.split()) for r in before.values())
            assert abs(sum(r.taken for r in after.values()) - 1.5 * total) <= max(len(r.text.split()) for r in before.values())


def test_stages_call_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "mixing"]
    assert corpus_pipeline.ORACLE_SQL is None and decontam.WINDOW == 10 and len(prose(1, 3).split()) == 3


def test_closures_carry_no_tables(spark):
    """What the driver has worked out stays there: a function sent to tasks is small all the same."""
    from pyspark import cloudpickle

    from orderlake.llm import quality, toxicity, vectext, winnow

    decontam.window_set([("a", "one two three four five six seven eight nine ten eleven")], 10)
    langid.grams(["some text"])
    winnow.winnow("some text that is long enough")
    for f in (lambda b: vectext.words(*b), lambda b: langid.decide(b, None), lambda b: winnow.winnow(b), lambda b: list(quality._buckets(b, 4)),
              lambda b: list(toxicity._features(b)), lambda b: list(decontam._scan_texts(b, None))):
        assert len(cloudpickle.dumps(f)) < 200_000


def test_release_drops_what_was_shared_and_frames_still_run(spark, awkward):
    from orderlake.llm import frames

    found = langid.predict(awkward, langid.learn(awkward))
    assert frames._SHARED
    frames.release()
    assert not frames._SHARED and found.count() == awkward.count()
