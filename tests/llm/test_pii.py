"""Personal data spans against a plain Python reading of the contract."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from orderlake.llm import pii, queries

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), n, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def found(spark, texts):
    rows = pii.find(frame(spark, texts)).collect()
    return {r.doc_id: [(s.kind, s.start, s.end, s.match, s.score) for s in r.spans] for r in rows}


def test_base_spans_match_the_contract_on_random_and_hard_texts(spark):
    rng = random.Random(5)
    alphabet = ["a", "Z", "é", "😀", "1", "22", "4539578763621486", "+", "+1", "@", ".", "-", " ", "(", ")", ",", "\n",
                "a@b.c", "10.0.0.1", "300.1.2.3", "x.y", "%", "_"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(1500)]
    texts += [None, "", "a@b.c_d@e.f@g.h", "1.2.3.4.5.6.7.8", "000255.1.1.1", "256.1.1.1 1.1.1.1", "+1 2 3)))))", "+12+345678901",
              "a" * 60_000, "1" * 60_000, "1 " * 30_000, "+1" + "(" * 60_000, "x@" + "y-" * 30_000, "1." * 30_000,
              "é a@b.co " * 3000, "a." * 20_000 + "@"]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert [(k, s, e) for k, s, e, _, _ in got[i] if k in pii.BASE] == base_spans(t), (t or "")[:80]
        assert all((t[s:e] == m) and 0 <= score <= 1 for _, s, e, m, score in got[i])


def test_added_kinds_need_their_checksum_or_context(spark):
    texts = ["iban DE89370400440532013000 x", "DE89 3704 0044 0532 0130 00", "DE88370400440532013000",
             "his ssn is 123-45-6789", "part 123-45-6789", "call (415) 555-0132 now", "lot (415) 555-0132", "666-45-6789 ssn"]
    got = found(spark, texts)
    kinds = [[k for k, *_ in got[i] if k not in pii.BASE] for i in range(len(texts))]
    assert kinds == [["iban"], ["iban"], [], ["ssn"], [], ["local_phone"], [], []]


def test_context_words_move_the_score(spark):
    got = found(spark, ["call +1 415 555 0132", "xx +1 415 555 0132", "isbn 4539578763621486", "visa 4539578763621486"])
    score = [got[i][0][4] for i in range(4)]
    assert score[0] > score[1] and score[3] > score[2]


def test_context_runs_on_over_neighbouring_matches(spark):
    texts = ["call 415-555-0133 or 415-555-0134", "call 415-555-0133, 415-555-0134 or 415-555-0135", "SSN 123-45-6789, 234-56-7891",
             "SSN: 123-45-6789 234-56-7891 345-67-8912", "123-45-6789, 234-56-7891 (ssn)", "ssn 123-45-6789" + " " * 60 + "234-56-7891"]
    got = found(spark, texts)
    assert [sum(k in ("ssn", "local_phone") for k, *_ in got[i]) for i in range(len(texts))] == [2, 3, 2, 3, 2, 1]
    # the declared 60 code points before and 20 after, whatever lies in them
    rng = random.Random(8)
    bits = ["call ", "ssn ", "order ", "visa ", "host ", "mail ", "é😀 ", "415-555-0133 ", "123-45-6789 ", "a@b.co ", "a@b.co", "10.0.0.1 ",
            "+1 415 555 0132 ", "4539578763621486 ", "x, ", " " * 9, "z" * 25 + " "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(300)] + ["call " + "415-555-0133 " * 300]
    got = found(spark, texts)
    rules = {r.kind: r for r in pii.RULES}
    for i, t in enumerate(texts):
        for kind, s, e, _, score in got[i]:
            rule, around = rules[kind], (t[max(0, s - 60):s] + " " + t[e:e + 20]).lower()
            near, against = (bool(words and re.search(rf"(?<![a-z])(?:{words})(?![a-z])", around)) for words in (rule.near, rule.against))
            assert abs(score - min(1, max(0, rule.score + 0.3 * near - 0.3 * against))) < 1e-9, (t, kind, s)
        bare = [m.start() for m in re.finditer(r"(?<![0-9-])123-45-6789(?![0-9-])", t)]
        cued = [s for s in bare if re.search(r"(?<![a-z])ssn(?![a-z])", t[max(0, s - 60):s] + " " + t[s + 11:s + 31])
                and not re.search(r"(?<![a-z])order(?![a-z])", t[max(0, s - 60):s] + " " + t[s + 11:s + 31])]
        assert [s for k, s, *_ in got[i] if k == "ssn"] == cued


def test_query_over_the_whole_table(spark):
    rows = queries.QUERIES["op2_pii"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts) and any(r.n_email for r in rows)
    for r in rows:
        base = base_spans(texts[r.doc_id])
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in PATTERNS]
        assert set(line.split(",")) <= set(r.spans.split(","))


def test_empty_table_extra_columns_and_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, _raw int")
    assert pii.find(empty).collect() == []
    twice = frame(spark, ["a@b.cd"]).unionAll(frame(spark, ["a@b.cd"])).withColumn("_raw", F.lit(1)).withColumn("kind", F.lit("z"))
    rows = pii.find(twice).collect()
    assert len(rows) == 2 and all(r._raw == 1 and r.kind == "z" and len(r.spans) == 1 for r in rows)


def brute_secrets(text):
    out = []
    for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}", text):
        core = m[0]
        p = [core.count(c) / len(core) for c in set(core)]
        bits = -sum(x * math.log2(x) for x in p)
        around = (text[max(0, m.start() - 60):m.start()] + " " + text[m.end():m.end() + 20]).lower()
        cue = re.search(r"(?<![a-z])(?:token|key|api[_-]?key|secret|password|passwd|passwort|clave|bearer|credential)(?![a-z])", around)
        if re.search("[0-9]", core) and re.search("[A-Za-z]", core) and bits >= pii.ENTROPY and cue:
            out.append(("secret", m.start(), m.end(), core))
    return out


def test_secrets(spark):
    rng = random.Random(7)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    base = lambda n: "".join(rng.choice("ABCdefGHIjkl0123456789+/") for _ in range(n))
    texts = [f'token = "{hexa(40)}"', f"the api_key: {base(32)}==, and {base(24)}", f"commit {hexa(40)} of the tree", f"Secret {hexa(19)} ",
             "key " + "a" * 30, "password abcdefghijklmnopqrstuvwxyz", "key 12345678901234567890", f"{hexa(30)} is the bearer", f"monkey {hexa(32)}",
             f"é token {'x' * 55}  {hexa(40)}", "key " + "ab1" * 20_000]
    parts = ["token", "key", "monkey", "x", hexa(25), base(30), hexa(40), "=", "-", " ", "\n", "é", "a" * 25, "1" * 25]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(300)]
    got = found(spark, texts)
    want = {i: brute_secrets(t) for i, t in enumerate(texts)}
    assert {i: [(k, s, e, m) for k, s, e, m, _ in got[i] if k == "secret"] for i in got} == want
    assert [bool(want[i]) for i in range(10)] == [True, True, False, False, False, False, False, True, False, False]


def test_the_query_counts_all_spans(spark):
    rows = queries.op2_pii(spark, SF01).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert all(r.n_spans == len([x for x in r.spans.split(",") if x]) for r in rows)
    planted = [r.n_spans for r in rows if re.search('token = "[0-9a-f]{40}"', texts[r.doc_id])]
    assert planted and min(planted) >= 1
