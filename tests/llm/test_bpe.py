"""The backtracking encoder against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderlake.llm import bpe, queries
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tables():
    return bpe.read(PATH)


@pytest.fixture(scope="module")
def encoder(tables):
    return bpe.Encoder(dict(tables))


def same(library, tables, encoder, text):
    want = library.encode(text, add_special_tokens=False).ids
    packed = encoder.packed(text)
    assert bpe.unpack(packed) == want, text[:100]
    assert bpe.decoded(tables, packed).decode("utf-8") == library.decode(want, skip_special_tokens=False)


def test_every_code_point(library, tables, encoder):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(points), 500):
        same(library, tables, encoder, "".join(f"a{c}!{c}1{c}{c} {c} " for c in points[lo:lo + 500]))


def test_random_words_and_special_tokens(library, tables, encoder):
    rng = random.Random(3)
    alphabets = ["ab", "aeioulnrst", "abcdefghijklmnopqrstuvwxyz", "0123!?'st", "éàüßaeñ中文か", "ÀȨ́́̃abΣ ", "'sretvmld "]
    for _ in range(4000):
        same(library, tables, encoder, "".join(rng.choice(a) for a in [rng.choice(alphabets)] for _ in range(rng.randrange(1, 60))))
    pieces = [s for s in tables["spelt"] if s]
    for _ in range(3000):  # words made of whole tokens meet at borders where merges compete
        raw = b"".join(bytes(ord(c) % 256 for c in rng.choice(pieces)) for _ in range(rng.randrange(1, 6)))
        same(library, tables, encoder, raw.decode("utf-8", "ignore"))
    for text in ["", " ", "<|endoftext|>", "a<|endoftext|><|startoftext|>b", "É<|endoftext|>́x", "<|endoftext", "x</w>y </w>", "\x00a\x1cb\x00", "ΑΣ ΣΑ"]:
        same(library, tables, encoder, text)


def test_long_words_take_linear_steps(library, tables, encoder):
    rng = random.Random(5)
    for word in ("a" * 20_000, "ab" * 10_000, "".join(rng.choice("ab") for _ in range(20_000)), "".join(rng.choice("the") for _ in range(20_000))):
        same(library, tables, encoder, word)


def test_small_pieces_and_small_memory_change_nothing(library, tables, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 40)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "DECODED", 7)
    encoder = bpe.Encoder(dict(tables))
    for seed in range(10):
        same(library, tables, encoder, prose(seed, 200).replace("tree", "<|endoftext|>").replace("river", "it's 12  \t"))


def test_together_is_what_merging_two_tokens_gives(tables):
    """Against merges replayed in order."""
    merges, spelt = tables["merges"], tables["spelt"]
    single = {s: t for t, s in enumerate(spelt) if len(s) == 1}

    def merged(letters):
        ids = [single[c] for c in letters]
        while True:
            known = [(merges[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in merges]
            if not known:
                return ids
            r, k = min(known)
            ids[k:k + 2] = [tables_by[r]]

    tables_by = {r: t for t, r in enumerate(tables["rank"]) if r >= 0}
    rng = random.Random(9)
    usable = [t for t, s in enumerate(spelt) if s and tables["shorter"][t] != -2]
    inner = [t for t in usable if ord(spelt[t][-1]) < 256]
    apart = 0
    for _ in range(3000):
        a, b = rng.choice(inner), rng.choice(usable)
        want = merged(spelt[a] + spelt[b]) == [a, b]
        apart += want
        assert bpe.together(tables, a, b) == want
    assert 300 < apart < 2900


def test_query(spark, library):
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op11_bpe(spark, SF).collect()
    assert len(found) == len(rows)
    for r in found:
        ids = library.encode(rows[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_awkward_rows(spark, awkward, nothing, library, tables):
    docs = awkward.withColumn("token_ids", awkward.k1).withColumn("Decoded", awkward.g)
    found = bpe.decode(bpe.encode(docs, tables), tables)
    assert found.columns[-2:] == ["token_ids", "decoded"] and len(found.columns) == len(awkward.columns) + 2
    rows = found.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in awkward.collect())
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert bpe.unpack(r["token_ids"]) == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(nothing, tables), tables).count() == 0
    odd = spark.createDataFrame([(None,), (bytearray(np.array([320, 10**6, 320], "<u4").tobytes()),)], "token_ids binary")
    assert sorted(r["decoded"] for r in bpe.decode(odd, tables).collect()) == ["", library.decode([320, 320])]


def test_a_text_of_several_megabytes(spark, tables, library):
    text = prose(11, 300_000)
    row = bpe.encode(spark.createDataFrame([(text,)], "text string"), tables).first()
    assert len(text) > 2 << 20 and bpe.unpack(row["token_ids"]) == library.encode(text, add_special_tokens=False).ids
