"""String column functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
The whitespace set is Python's (``str.isspace``), which is what the reference's
``re.sub(r'\\s+', ...)``, ``str.split()`` and ``str.strip()`` use. It is written
out as explicit ``\\x{..}`` escapes so the same pattern means the same thing
in Java regex (Spark) and RE2 (the DuckDB oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace code points, derived by rule (all lie below U+3001).
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _ranges(chars: str) -> str:
    """Character-class body with consecutive code points merged into ranges
    (Java's regex tests a short range list far faster than many singletons)."""
    cps = sorted(ord(c) for c in chars)
    out, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        out.append(f"\\x{{{start:x}}}" if start == prev else f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        if cp is not None:
            start = prev = cp
    return "".join(out)


# Portable class (Java and RE2), used by the SQL oracle.
WS_CLASS = "[" + _ranges(WS_CHARS) + "]"
# The same set for Spark's Java regex: Unicode White_Space plus U+001C-U+001F,
# tested as one property (several times faster than a list of code points).
WS_RE = "(?U:[\\s\\x{1c}-\\x{1f}])"

CHUNK_LEN = 512


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """T2 ``str.strip()``: remove leading/trailing Python whitespace."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """T1 ``re.sub(r'\\s+', ' ', x).strip()`` == ``' '.join(x.split())``."""
    return strip_ws(F.regexp_replace(_col(c), WS_RE + "+", " "))


def lower(c) -> Column:
    """T3 ``str.lower()``."""
    return F.lower(_col(c))


def remove_phrase(c, phrase: str) -> Column:
    """T4 ``x.replace(phrase, '').strip()``: every occurrence, case-sensitive."""
    return strip_ws(F.replace(_col(c), F.lit(phrase), F.lit("")))


def replace_char(c, old: str, new: str) -> Column:
    """T5 one-character replacement (``'à'`` -> ``' '``)."""
    return F.translate(_col(c), old, new)


def drop_newlines(c) -> Column:
    """T6 ``x.replace('\\n', '')``: no space is inserted."""
    return F.replace(_col(c), F.lit("\n"), F.lit(""))


def chunks(c, size: int = CHUNK_LEN) -> Column:
    """T8 ``[x[j:j+size] for j in range(0, len(x), size)]`` by code point.

    An empty string gives an empty array; the last chunk may be short.
    """
    x = _col(c)
    n = F.length(x)
    starts = F.filter(F.sequence(F.lit(0), n, F.lit(size)), lambda j: j < n)
    return F.transform(starts, lambda j: F.substring(x, j + 1, size))

