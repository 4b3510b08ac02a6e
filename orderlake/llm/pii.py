"""Personal data in texts (DataFrame functions only, row-local, no shuffle).

Regular expressions propose spans, checksums (Luhn for cards, mod-97 for bank
accounts) and number ranges confirm them, and context words near a span raise or
lower its score. Spans are code point offsets, end exclusive.

Base kinds: email, ip, card, phone; a base span that its check confirms is always
reported, whatever its score. Further kinds: iban (confirmed by mod-97), ssn and
local_phone (a bare number pattern says little, so these two need a context word
nearby to reach ``THRESHOLD``), and secret: keys and tokens in hexadecimal or base64, confirmed by the entropy of
their characters, with a context word likewise.

Positions come from the pieces between matches: a text is split at the pattern and
the lengths are added up in blocks, so a text with very many matches stays far from quadratic
time. The patterns start only where a run starts (or where the last match ended)
and are possessive, so they are linear in the text and use no regex stack; they
match what the plain patterns of the contract match.

Defined results: a null or empty text has no span; spans of different kinds may
overlap and are all reported; rows that repeat are judged each on its own; empty tables give
empty results. Extra columns pass through; a column named like a result column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import fresh, let, cleared, sums_before

#: Kinds in the order in which spans with equal starts are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone", "secret")
BASE = KINDS[:4]
THRESHOLD = 0.6
#: Least entropy of a secret's characters, in bits; prose and repeated letters stay below it or lack digits.
ENTROPY = 3.0
#: Code points before a span in which context words count, and after it.
BEFORE, AFTER = 60, 20

_LOCAL = r"A-Za-z0-9._%+-"
_IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)"

Check = Callable[[Column], Column]


@dataclass(frozen=True)
class Rule:
    kind: str
    #: Cheap test that a text may hold the pattern.
    hint: str
    pattern: str
    confirm: Check
    score: float
    #: Words that raise the score, and words that lower it.
    near: str
    against: str = ""


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test: every second digit from the right doubled."""
    each = F.split(F.reverse(number), "")
    value = F.transform(each, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(value, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an IBAN (letters and digits) leaves 1 modulo 97, its first four characters moved to the end."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    value = F.transform(F.split(F.upper(turned), ""), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(value, F.lit(0), lambda a, v: (F.when(v > 9, a * 100).otherwise(a * 10) + v) % 97)
    return rest == 1


def _card(match: Column) -> Column:
    n = F.length(_digits(match))
    return (n >= 12) & (n <= 19) & luhn(_digits(match))


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _iban(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    return F.length(plain).between(15, 34) & mod97(plain)


def entropy(match: Column) -> Column:
    """Bits a character of a string, by how often each occurs in it."""
    def bits(chars: Column) -> Column:
        n = F.size(chars).cast("double")
        each = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n)
        return F.aggregate(each, F.lit(0.0), lambda a, p: a - p * F.log2(p))

    return let(F.split(match, ""), bits)


def _secret(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (entropy(match) >= ENTROPY)


RULES = (
    Rule("email", "@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), 0.9, "e-?mail|mail|contact|write|kontakt|correo|courriel"),
    Rule("ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda m: m.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"), 0.7, "ip|address|host|server|login", "version|section|chapter"),
    Rule("card", r"[0-9][ -]?[0-9][ -]?[0-9]", r"[0-9]++(?:[ -][0-9]++)*+", _card, 0.8,
         "card|visa|credit|debit|karte|carte|tarjeta", "isbn|order|serial|tracking"),
    Rule("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", _phone, 0.7, "phone|call|tel|mobile|fax|anruf|appel|llama"),
    Rule("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", _iban, 0.8,
         "iban|account|bank|konto|compte|cuenta"),
    Rule("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
         r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", lambda m: F.lit(True), 0.4,
         "ssn|social security|social-security", "order|invoice|part|serial"),
    Rule("local_phone", r"[0-9]{3}[ .-][0-9]{4}",
         r"(?<![0-9+(.-])(?<!\+[0-9]{1,3}[ (])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])", lambda m: F.lit(True), 0.4,
         "phone|call|tel|telephone|mobile|cell|fax", "order|invoice|serial|isbn"),
    Rule("secret", r"[A-Za-z0-9+/_-]{20}", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}", _secret, 0.4,
         "token|key|api[_-]?key|secret|password|passwd|passwort|clave|bearer|credential"),
)


_SPANS = "array<struct<start:bigint,kind_no:int,end:bigint,match:string,score:double>>"


def _found(text: Column, rule: Rule, has_digit: Column) -> Column:
    """Confirmed spans of one rule in one text."""
    number = KINDS.index(rule.kind)

    def spans(ms: Column, ps: Column) -> Column:
        lengths = F.transform(ms, lambda m, i: (F.length(m) + F.length(F.get(ps, i))).cast("long"))
        # the text up to and from each match, as far as the context of its neighbours can reach
        upto = F.transform(ms, lambda m, i: F.right(F.concat(F.get(ps, i), m), F.lit(BEFORE)))
        since = F.transform(ms, lambda m, i: F.left(F.concat(m, F.get(ps, i + 1)), F.lit(AFTER)))
        return let(sums_before(lengths), lambda ahead: let(upto, lambda us: let(since, lambda ss: F.transform(ms, lambda m, i: let(
            ahead[i] + F.length(F.get(ps, i)), lambda start: F.struct(
                start.alias("start"), F.lit(number).alias("kind_no"), (start + F.length(m)).alias("end"), m.alias("match"),
                _score(rule, _before(us, ps, i), _after(ss, ps, i)).alias("score")))))))

    kept = (lambda s: rule.confirm(s["match"])) if rule.kind in BASE else (
        lambda s: rule.confirm(s["match"]) & (s["score"] >= THRESHOLD))
    proposed = let(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
                   lambda ms: let(F.split(text, rule.pattern, -1), lambda ps: spans(ms, ps)))
    may = text.contains(rule.hint) if rule.hint.isalnum() or rule.hint == "@" else has_digit & text.rlike(rule.hint)
    return F.when(may, F.filter(proposed, kept)).otherwise(F.array().cast(_SPANS))


def _before(upto: Column, ps: Column, i: Column) -> Column:
    """The ``BEFORE`` code points before match ``i``, over earlier matches (of a code point at least) and pieces."""
    own = F.get(ps, i)
    run = F.concat(F.array_join(F.slice(upto, F.greatest(i - BEFORE + 1, F.lit(1)), F.least(i, F.lit(BEFORE))), ""), own)
    return F.right(F.when(F.length(own) >= BEFORE, own).otherwise(run), F.lit(BEFORE))


def _after(since: Column, ps: Column, i: Column) -> Column:
    """The ``AFTER`` code points after match ``i``, over later matches and pieces."""
    own = F.get(ps, i + 1)
    run = F.concat(own, F.array_join(F.slice(since, i + 2, F.lit(AFTER)), ""))
    return F.left(F.when(F.length(own) >= AFTER, own).otherwise(run), F.lit(AFTER))


def _score(rule: Rule, before: Column, after: Column) -> Column:
    around = F.lower(F.concat_ws(" ", before, after))
    up = F.when(around.rlike(rf"(?<![a-z])(?:{rule.near})(?![a-z])"), 0.3).otherwise(0.0)
    down = F.when(around.rlike(rf"(?<![a-z])(?:{rule.against})(?![a-z])"), 0.3).otherwise(0.0) if rule.against else F.lit(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(rule.score) + up - down))


def find(docs: DataFrame, *, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus ``spans``: kind, start, end, match and score, by start, then kind as in ``KINDS``, then end."""
    docs = cleared(docs, "spans")
    raw, = fresh(docs, "_raw")
    body = F.coalesce(F.col(text), F.lit(""))
    has_digit = body.rlike("[0-9]")
    found = docs.withColumn(raw, F.array_sort(F.flatten(F.array(*[_found(body, r, has_digit) for r in rules]))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return found.withColumn("spans", F.transform(raw, lambda s: F.struct(
        F.get(names, s["kind_no"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["match"].alias("match"), s["score"].alias("score")))).drop(raw)


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
