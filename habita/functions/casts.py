"""Type casts with the stream job's (legacy, non-ANSI) semantics, written so
that they also hold under ANSI mode: bad input becomes NULL instead of an error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .patterns import LEGACY_INT, LEGACY_INT_FRACTION_ONLY


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def legacy_int(x) -> Column:
    """string -> int like the legacy cast: ' 3 ' -> 3, '3.7' -> 3, '.5' -> 0,
    '1e3' / overflow / text / '' -> NULL."""
    x = _c(x)
    digits = F.nullif(F.regexp_extract(x, LEGACY_INT, 1), F.lit(""))
    frac_only = F.when(x.rlike(LEGACY_INT_FRACTION_ONLY), F.lit("0"))
    return F.coalesce(digits, frac_only).try_cast("int")


def legacy_float(x) -> Column:
    """string -> float; accepts '1e3', 'NaN', 'Infinity', '1f'; junk -> NULL."""
    return _c(x).try_cast("float")


def legacy_long(x) -> Column:
    """The price column is already bigint on the wire: the cast is a no-op."""
    return _c(x).cast("long")


def digits_only_int(x) -> Column:
    """Disabled stream rule X1: keep digits only, then cast ('45.5' -> 455)."""
    return F.nullif(F.regexp_replace(_c(x), "[^0-9]", ""), F.lit("")).try_cast("int")


def digits_only_float(x) -> Column:
    return F.nullif(F.regexp_replace(_c(x), "[^0-9]", ""), F.lit("")).try_cast("float")


def lenient_price(raw_text) -> Column:
    """Opt-in repair: accept a price sent as a quoted integer ("15000").

    ``raw_text`` is the price field read as text; only plain integers count.
    """
    t = F.trim(_c(raw_text))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))
