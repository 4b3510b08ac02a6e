"""Byte-pair encoding with a public vocabulary: exact merges by a backtracking encoder, decoding by an offset table.

A sequence of tokens is the result of the merges if and only if every token gives itself when merged alone
and every two neighbours stay apart when merged together. So no merge is ever replayed: an Aho-Corasick automaton
names the longest token that ends at each place of a word, tokens are laid from the word's end, the longest
first, a neighbour that would have merged across the border is refused, and a place from which nothing
fits is marked and never tried again. A word costs time in proportion to its length.

The vocabulary is a tokenizer file of the ``BPE`` kind whose words come from a normalizer and a split
pattern (see ``read``). Its tables (49,408 tokens: 5 MB) are broadcast, a bound the vocabulary sets and not the data.
Which code points are letters, digits or blanks, and what they are in lower case, is asked once of the installed
library, since its Unicode version need not be Python's.

Token ids are kept packed, as little-endian unsigned 32-bit integers in a binary column, the form in which
training shards store them; ``unpack`` reads them.

Defined results: a null or empty text has no tokens and decodes to the empty text; special tokens' strings in
a text become their ids; ids outside the vocabulary are skipped by ``decode``. Long texts are cut at blanks
(no token crosses one) and handled in pieces. Rows that repeat are encoded each on its own; an empty
table gives an empty one; extra columns pass through, one named like the result is replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.frames import cleared, share

#: Code points of a text worked on at a time (up to the next blank).
PIECE = 1 << 20
#: Distinct words whose ids a task remembers, and the longest of them in bytes; others are encoded anew.
REMEMBERED, LONGEST = 250_000, 64
#: Ids decoded at a time.
DECODED = 1 << 17

_BLANK = re.compile(r"[ \t\n\r]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [letter[b] for b in range(256)]


def _code_points() -> str:
    return "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)


def _class(pattern: str) -> str:
    """The code points that the library's ``pattern`` matches, written as the inside of a character class."""
    from tokenizers import Regex, pre_tokenizers

    every = _code_points()
    runs = pre_tokenizers.Split(Regex(pattern + "+"), "removed", invert=True).pre_tokenize_str(every)
    # runs of the string are runs of code points but for the gap of the surrogates
    return "".join(f"\\U{ord(every[a]):08x}-\\U{ord(every[b - 1]):08x}" for _, (a, b) in runs)


def _lower_differs() -> dict[str, str]:
    """Letters whose lower case in the library is not Python's."""
    from tokenizers import normalizers

    every = _code_points().replace("\n", "")
    theirs = normalizers.Lowercase().normalize_str("\n".join(every)).split("\n")
    return {c: low for c, low in zip(every, theirs) if low != c.replace("Σ", "σ").lower()}


def read(path: str) -> dict:
    """The tables of a tokenizer file, as plain data.

    Read are a ``BPE`` model whose merges are in the order of training, byte-level letters, an end-of-word
    suffix, the NFC and Lowercase normalizers, and one split pattern over ``\\s``, ``\\p{L}`` and ``\\p{N}``.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, end = file["model"], file["model"]["end_of_word_suffix"] or ""
    split = file["pre_tokenizer"]["pretokenizers"][0]
    known = {"NFC", "Replace", "Lowercase"}
    if (model["type"] != "BPE" or not end or model.get("continuing_subword_prefix") or model.get("unk_token") or file["decoder"]
            or split["type"] != "Split" or not split["invert"] or {n["type"] for n in file["normalizer"]["normalizers"]} - known
            or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in file["added_tokens"])):
        raise ValueError(f"{path}: a kind of tokenizer that is not read here")
    vocab: dict[str, int] = model["vocab"]
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    # a word's letters are its bytes, the last one raised by 256
    spelt = [""] * size
    for byte, letter in enumerate(byte_letters()):
        spelt[vocab[letter]], spelt[vocab[letter + end]] = chr(byte), chr(256 + byte)
    left, right, rank = [-1] * size, [-1] * size, [-1] * size
    merges: dict[tuple[int, int], int] = {}
    for r, merge in enumerate(model["merges"]):
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        x, y, t = vocab[a], vocab[b], vocab[a + b]
        if not spelt[x] or not spelt[y] or spelt[t]:
            raise ValueError(f"{path}: merge {r} is out of order or makes a token twice")
        spelt[t], left[t], right[t], rank[t] = spelt[x] + spelt[y], x, y, r
        merges[x, y] = r
    names = [""] * size
    for token, t in {**vocab, **special}.items():
        names[t] = token
    coded = [(n + " ").encode("utf-8") if n else b"" for n in names]
    tables = {"left": left, "right": right, "rank": rank, "merges": merges, "spelt": spelt, "special": special,
              "text": b"".join(coded), "offsets": np.concatenate(([0], np.cumsum([len(c) for c in coded]))).astype(np.int64),
              "words": _pattern(split["pattern"]["Regex"]), "lower": _lower_differs()}
    tables["shorter"] = _suffixes(tables)
    return tables


def _pattern(theirs: str) -> str:
    """The split pattern for Python's ``re``: the library's classes spelt out."""
    theirs = re.sub(r"\[(\\p\{\w\})\]", r"\1", theirs)
    classes = {c: _class(c) for c in (r"\s", r"\p{L}", r"\p{N}")}
    out = theirs.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(classes.values()) + "]")
    for c, inside in classes.items():
        out = out.replace(c, "[" + inside + "]")
    return out


def together(tables: dict, a: int, b: int, made: int = -1) -> bool:
    """Whether merges leave tokens ``a`` and ``b`` as neighbours (but for the merge into ``made``).

    Goes back through the merges that made both, the later one first, and looks at each time at the two symbols at the
    border: had they a merge of their own that came before either was used up, the border would have gone. Of
    equal merges the left one comes first.
    """
    left, right, rank, merges = tables["left"], tables["right"], tables["rank"], tables["merges"]
    x, y, x_used, y_used = a, b, len(merges), len(merges)
    while True:
        r = merges.get((x, y))
        if r is not None and r < x_used and r <= y_used and (made < 0 or r != rank[made]):
            return False
        if rank[x] < 0 and rank[y] < 0:
            return True
        if rank[x] > rank[y]:
            x, x_used = right[x], rank[x]
        else:
            y, y_used = left[y], rank[y]


def _suffixes(tables: dict) -> list[int]:
    """For each token the longest token that ends it, -1: none, -2: the token is not the result of its own letters."""
    left, right, spelt = tables["left"], tables["right"], tables["spelt"]
    usable: dict[str, int] = {}
    for t in sorted((t for t in range(len(spelt)) if spelt[t]), key=tables["rank"].__getitem__):
        whole = left[t] < 0 or (spelt[left[t]] in usable and spelt[right[t]] in usable and together(tables, left[t], right[t], t))
        if whole:
            usable[spelt[t]] = t
    out = [-2] * len(spelt)
    for s, t in usable.items():
        out[t] = next((usable[s[k:]] for k in range(1, len(s)) if s[k:] in usable), -1)
    return out


class Encoder:
    """Encodes texts with the tables of ``read``. One stands in each task."""

    def __init__(self, tables: dict):
        import ahocorasick

        self.tables, self.shorter = tables, tables["shorter"]
        self.length = [len(s) for s in tables["spelt"]]
        self.ends = ahocorasick.Automaton()
        for t, s in enumerate(tables["spelt"]):
            if self.shorter[t] != -2:
                self.ends.add_word(s, t)
        self.ends.make_automaton()
        self.compatible: dict[int, bool] = {}
        self.remembered: dict[str, bytes] = {}
        self.words = re.compile(tables["words"]).findall
        ascii_only = r"\U[0-9a-f]{8}-\U[0-9a-f]{8}".replace("\\U", r"\\U")
        self.ascii_words = re.compile(re.sub(ascii_only, _ascii_part, tables["words"])).findall
        self.odd = re.compile("[" + re.escape("".join(tables["lower"])) + "]").search if tables["lower"] else None
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(tables["special"], key=len, reverse=True))) + ")").split

    def _test(self, a: int, b: int) -> bool:
        if len(self.compatible) >= 1_000_000:
            self.compatible.clear()
        fits = self.compatible[a << 32 | b] = together(self.tables, a, b)
        return fits

    def word(self, word: str) -> list[int]:
        """Token ids of one word."""
        raw = word.encode("utf-8")
        letters = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        longest = [-1] * (len(letters) + 1)
        for last, t in self.ends.iter(letters):  # of the tokens that end here the longest comes first
            if longest[last + 1] < 0:
                longest[last + 1] = t
        length, shorter, compatible = self.length, self.shorter, self.compatible
        at = len(letters)
        t = longest[at]
        if length[t] == at:
            return [t]
        out = [t]
        closed = bytearray(at + 1)
        at -= length[t]
        t = longest[at]
        while at:
            while t >= 0:
                if not closed[at - length[t]]:
                    if not out:
                        break
                    fits = compatible.get(t << 32 | out[-1])
                    if fits or (fits is None and self._test(t, out[-1])):
                        break
                t = shorter[t]
            if t >= 0:
                out.append(t)
                at -= length[t]
                t = longest[at]
            else:  # no token fits before this place, so none begins here
                closed[at] = 1
                t = out.pop()
                at += length[t]
                t = shorter[t]
        out.reverse()
        return out

    def _packed(self, word: str) -> bytes:
        ids = np.array(self.word(word), "<u4").tobytes()
        if len(word) <= LONGEST:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            self.remembered[word] = ids
        return ids

    def _lowered(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if self.odd and self.odd(text):
            differs = self.tables["lower"]
            return "".join(differs.get(c) or c.replace("Σ", "σ").lower() for c in text)
        return text.replace("Σ", "σ").lower()

    def _piece(self, text: str) -> bytes:
        text = self._lowered(text)
        found, known = (self.ascii_words if text.isascii() else self.words)(text), self.remembered
        return b"".join([known.get(w) or self._packed(w) for w in found])

    def packed(self, text: str) -> bytes:
        """Ids of a text, packed."""
        out, lo = [], 0
        while lo < len(text):
            blank = _BLANK.search(text, lo + PIECE)
            hi = blank.end() if blank else len(text)
            for k, part in enumerate(self.special(text[lo:hi])):
                out.append(self.tables["special"][part].to_bytes(4, "little") if k % 2 else self._piece(part))
            lo = hi
        return b"".join(out)


def _ascii_part(found: re.Match) -> str:
    """The part below 128 of a range of code points; none: one code point that no ASCII text holds."""
    a, b = (int(x[2:], 16) for x in found.group().split("-"))
    return f"\\x{a:02x}-\\x{min(b, 127):02x}" if a < 128 else "\\x80"


def decoded(tables: dict, packed: bytes) -> bytes:
    """The UTF-8 text of packed ids: their tokens with a space between, cut out of one buffer by offsets."""
    ids, text, offsets = np.frombuffer(packed, "<u4"), np.frombuffer(tables["text"], np.uint8), tables["offsets"]
    out = []
    for lo in range(0, len(ids), DECODED):
        part = ids[lo:lo + DECODED].astype(np.int64)
        part = part[part < len(offsets) - 1]
        first, size = offsets[part], offsets[part + 1] - offsets[part]
        shift = first - (np.cumsum(size) - size)
        out.append(text[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes())
    return b"".join(out)[:-1]


def unpack(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def _texts(column: pa.Array) -> Iterator[str]:
    for t in column.cast(pa.binary()):
        yield (t.as_py() or b"").decode("utf-8", "replace")


class _InTask:
    """Broadcast tables with the encoder that a worker process builds once from them."""

    def __init__(self, shared):
        self.shared = shared

    def encoder(self) -> Encoder:
        tables = self.shared.value
        if "encoder" not in tables:
            tables["encoder"] = Encoder(dict(tables))
        return tables["encoder"]


def encode(docs: DataFrame, tables: dict, *, text: str = "text", out: str = "token_ids", back: str | None = None,
           drop_text: bool = False) -> DataFrame:
    """``docs`` plus the packed ids of ``text``, and under the name ``back``, if given, the text that they decode to."""
    docs = cleared(docs, out, *([back] if back else []))
    at, kept = docs.columns.index(text), [k for k, c in enumerate(docs.columns) if not (drop_text and c == text)]
    task = _InTask(share(docs, tables))

    def run(batches):
        for batch in batches:
            encoder = task.encoder()
            ids = [encoder.packed(t) for t in _texts(batch.column(at))]
            made = [pa.array(ids, pa.binary())]
            if back:
                made.append(pa.array([decoded(encoder.tables, i) for i in ids], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *made], names=[*(batch.schema.names[k] for k in kept), *added])

    added = [out, *([back] if back else [])]
    kinds = (T.BinaryType(), T.StringType())
    return docs.mapInArrow(run, T.StructType([*(docs.schema[k] for k in kept), *map(T.StructField, added, kinds)]))


def decode(docs: DataFrame, tables: dict, *, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` plus the text of the packed ids (null: empty)."""
    docs = cleared(docs, out)
    at = docs.columns.index(ids)
    shared = share(docs, {k: tables[k] for k in ("text", "offsets")})

    def run(batches):
        for batch in batches:
            texts = [decoded(shared.value, p.as_py() or b"") for p in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())]))


def n_tokens(ids: str = "token_ids"):
    return (F.octet_length(ids) / 4).cast("long")
