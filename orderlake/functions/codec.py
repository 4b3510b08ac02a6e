"""Base64, UTF-8, JSON and digest helpers.

``try_to_binary(x, 'base64')`` returns null for bad input, unlike
``unbase64``, which yields empty bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: JSON as the order model reads it: NaN and infinities pass, single quotes do not.
JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def b64_decode(c) -> Column:
    """Base64 text -> bytes: characters outside the alphabet are skipped, what is left must be padded.

    Null for a group that stays incomplete and for padding inside the text; padding beyond what is needed is ignored.
    """
    x = _c(c)

    def cleaned(y: Column) -> Column:
        data = F.rtrim(y, F.lit("="))
        rest, pads = F.length(data) % 4, F.length(y) - F.length(data)
        ok = ~data.contains("=") & ((rest == 0) | ((rest > 1) & (pads >= 4 - rest)))
        return F.when(ok, F.try_to_binary(F.concat(data, F.repeat(F.lit("="), (4 - rest) % 4)), F.lit("base64")))

    # most values are clean, and need no pass of a regular expression
    return F.coalesce(F.when(F.length(x) % 4 == 0, F.try_to_binary(x, F.lit("base64"))),
                      once(F.regexp_replace(x, "[^A-Za-z0-9+/=]", ""), cleaned))


def b64_encode(c) -> Column:
    """Bytes or text -> base64 without the line breaks Spark inserts."""
    return F.replace(F.base64(_c(c)), F.lit("\r\n"), F.lit(""))


def utf8_strict(b) -> Column:
    """Bytes -> text, null when not valid UTF-8."""
    return F.try_validate_utf8(_c(b).cast("string"))


def utf8_lenient(b) -> Column:
    """Bytes -> text, invalid sequences dropped; a replacement character that was in the bytes stays.

    It waits as the noncharacter U+FDD0, which texts for interchange do not hold.
    """
    genuine, aside = F.lit("\ufffd"), F.lit("\ufdd0")
    marked = F.make_valid_utf8(F.replace(_c(b).cast("string"), genuine, aside))
    return F.replace(F.replace(marked, genuine, F.lit("")), aside, genuine)


def json_objects(text, key: str | None = None) -> Column:
    """The object in a JSON text, or the objects in its list, each as a map of texts; with ``key``, those that have it.

    An empty array for malformed text, for text after the value, and for scalars. In a list, a text that
    spells an object counts as one.
    """
    text = F.trim(_c(text))
    # in brackets, a text that goes on after its value is malformed, has a second element or does not end as it should
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    none = F.array().cast("array<map<string,string>>")

    def with_key(maps: Column) -> Column:
        return F.filter(maps, lambda m: m.isNotNull() if key is None else m.isNotNull() & F.map_contains_key(m, key))

    def elements(values: Column) -> Column:
        objects = F.filter(F.from_json(F.get(values, 0), "array<string>", JSON_OPTIONS), lambda e: F.ltrim(e).startswith("{"))
        return with_key(F.transform(objects, lambda e: F.from_json(e, "map<string,string>", JSON_OPTIONS)))

    one = once(F.from_json(wrapped, "array<map<string,string>>", JSON_OPTIONS), lambda ms: F.when(F.size(ms) == 1, with_key(ms)))
    many = once(F.from_json(wrapped, "array<string>", JSON_OPTIONS), lambda vs: F.when(F.size(vs) == 1, elements(vs)))
    return F.coalesce(F.when(text.startswith("{") & text.endswith("}"), one).when(
        text.startswith("[") & text.endswith("]"), many), none)


def sha256_hex(c) -> Column:
    return F.sha2(_c(c).cast("string"), 256)
