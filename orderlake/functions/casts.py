"""Lenient casts.

ANSI mode is on by default in Spark 4: ``cast('x' as int)`` and
``to_timestamp('')`` raise. The order model expects unparsable input to become
null, so every cast here is a ``try_`` form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_string(c) -> Column:
    return _c(c).cast("string")


def try_double(c) -> Column:
    """String or number -> double; unparsable and the text NaN -> null."""
    d = _c(c).try_cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def try_int(c) -> Column:
    """String or number -> int, via double so ``'2.5'`` gives 2 (truncation)."""
    return _c(c).try_cast("double").try_cast("int")


def try_bool(c) -> Column:
    return _c(c).try_cast("boolean")


def parse_ts(c) -> Column:
    """Date or date-time text -> timestamp; ``''`` and ``'nan'`` -> null."""
    return F.try_to_timestamp(_c(c))


def finite_or_null(c) -> Column:
    """NaN and +-inf -> null (double column)."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


def numeric_feature(c) -> Column:
    """coerce to double, +-inf/NaN -> null, null -> 0."""
    return F.coalesce(finite_or_null(_c(c).try_cast("double")), F.lit(0.0))


def bool_flag(c) -> Column:
    """F8: boolean -> 0/1, null -> 0."""
    return F.coalesce(_c(c).cast("int"), F.lit(0))


def null_flag(c) -> Column:
    """1 when null, else 0."""
    return _c(c).isNull().cast("int")
