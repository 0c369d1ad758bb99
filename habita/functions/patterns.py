"""Regex building blocks shared by the Spark expressions and the SQL oracle.

The character classes are written out explicitly so that Java regex (Spark)
and RE2 (DuckDB) read them the same way.
"""

# The whitespace set of Python's str.isspace() / str.strip(),
# as an explicit class (Java \s and RE2 \s are ASCII-only).
PY_WS_CHARS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
PY_WS = f"[{PY_WS_CHARS}]"
# Python's \d on str: any Unicode decimal digit.
PY_DIGIT = r"\p{Nd}"
PY_NON_DIGIT = r"\P{Nd}"

# The same set as a plain string of characters (for btrim).
PY_WS_STRING = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                + "".join(chr(c) for c in range(0x2000, 0x200B))
                + "\u2028\u2029\u202f\u205f\u3000")

# Leading/trailing whitespace as Python's strip() removes it.
PY_STRIP = f"^{PY_WS}+|{PY_WS}+$"

# Legacy (non-ANSI) string -> int cast: optional sign, digits, an optional
# fraction that is truncated; surrounding ASCII whitespace/control allowed.
LEGACY_INT = r"^[\x00-\x20]*([+-]?[0-9]+)(?:\.[0-9]*)?[\x00-\x20]*$"
LEGACY_INT_FRACTION_ONLY = r"^[\x00-\x20]*[+-]?\.[0-9]*[\x00-\x20]*$"

URL_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"
URL_AUTHORITY = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
URL_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"
URL_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
