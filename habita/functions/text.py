"""Text extraction expressions: Python-compatible strip, digit runs, pattern
priority lists, location splitting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .patterns import PY_DIGIT, PY_NON_DIGIT, PY_WS, PY_WS_CHARS, PY_WS_STRING


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace (Spark ``trim`` only
    removes U+0020); ``btrim`` with the explicit character set, no regex."""
    return F.btrim(_c(x), F.lit(PY_WS_STRING))


def blank_to_null(x) -> Column:
    return F.nullif(_c(x), F.lit(""))


def price_digits(text) -> Column:
    """First run of digits/whitespace with the whitespace removed.

    No run at all -> '0'; the first run can be pure whitespace, which gives ''.
    Input NULL (selector found nothing) reads as the default text '0'.
    """
    t = F.coalesce(_c(text), F.lit("0"))
    run = F.regexp_extract(t, f"[{PY_DIGIT}{PY_WS_CHARS}]+", 0)
    return F.when(t.rlike(f"[{PY_DIGIT}{PY_WS_CHARS}]"), F.regexp_replace(run, PY_WS, "")) \
            .otherwise(F.lit("0"))


def price_digits_dotted(text) -> Column:
    """E5: first run of digits/whitespace/dots; drop '.' and U+0020 only;
    empty result or no run -> '0'."""
    t = F.coalesce(_c(text), F.lit(""))
    run = F.regexp_extract(t, f"[{PY_DIGIT}{PY_WS_CHARS}.]+", 0)
    cleaned = F.replace(F.replace(run, F.lit("."), F.lit("")), F.lit(" "), F.lit(""))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit("0"))


def digits_only(x) -> Column:
    """Remove every non-digit character."""
    return F.regexp_replace(_c(x), PY_NON_DIGIT, "")


def first_integer(x) -> Column:
    """The first run of digits, NULL when there is none."""
    return blank_to_null(F.regexp_extract(_c(x), f"({PY_DIGIT}+)", 1))


def first_pattern(text, patterns) -> Column:
    """Group 1 of the first pattern (in priority order) that matches."""
    t = _c(text)
    return F.coalesce(*[blank_to_null(F.regexp_extract(t, p, 1)) for p in patterns])


# Patterns of the classifieds detail page, in priority order.
SURFACE_PATTERNS = [rf"({PY_DIGIT}+){PY_WS}*m²", rf"({PY_DIGIT}+){PY_WS}*m2",
                    rf"surface{PY_WS}*:?{PY_WS}*({PY_DIGIT}+)"]
ROOM_PATTERNS = [rf"({PY_DIGIT}+){PY_WS}*pièces?", rf"({PY_DIGIT}+){PY_WS}*chambres?"]
WC_PATTERN = rf"({PY_DIGIT}+){PY_WS}*(?:wc|toilette)"


def surface_from_text(lower_text) -> Column:
    return first_pattern(lower_text, SURFACE_PATTERNS)


def rooms_from_text(lower_text) -> Column:
    return first_pattern(lower_text, ROOM_PATTERNS)


def wc_from_text(lower_text) -> Column:
    """E15: 'N wc' / 'N toilette'."""
    return blank_to_null(F.regexp_extract(_c(lower_text), WC_PATTERN, 1))


def split_location(location_full) -> tuple[Column, Column]:
    """Returns (neighborhood, city) from 'quartier, ville[, pays]'.

    With a comma: parts are stripped; neighborhood = first part; city = the
    second-last part when the last one contains 'Togo', else the last part.
    Without a comma: city = whole text, neighborhood = ''.
    """
    loc = F.coalesce(_c(location_full), F.lit(""))
    parts = F.transform(F.split(loc, ","), lambda p: py_strip(p))
    has_comma = loc.contains(",")
    last = F.try_element_at(parts, F.lit(-1))
    city = F.when(has_comma,
                  F.when(last.contains("Togo"), F.try_element_at(parts, F.lit(-2))).otherwise(last)) \
            .otherwise(loc)
    hood = F.when(has_comma, F.try_element_at(parts, F.lit(1))).otherwise(F.lit(""))
    return hood, city
