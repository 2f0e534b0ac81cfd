"""Text expressions as built-in Spark Columns (JVM-side, codegen-friendly).

Every pattern here is written so the same string means the same thing in Java
regex (Spark) and RE2 (DuckDB, used as the test oracle): no ``\\w`` or ``\\s``
shorthands, whose meaning differs between the two engines for non-ASCII text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() / re "\s" treat as
# whitespace, written as one regex class valid in Java and RE2.
WS = ("[\\t\\n\\x{0B}\\f\\r \\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}"
      "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]")
WS_RUN = WS + "+"
EDGE_WS = "^" + WS_RUN + "|" + WS_RUN + "$"
# Word characters: letters, digits and underscore in any script.
WORD = "[\\p{L}\\p{N}_]"
WORD_RUN = WORD + "+"
# Word tokens plus single punctuation marks (the word-tokenise column, B6).
TOKEN = WORD_RUN + "|[^\\p{L}\\p{N}_" + WS[1:]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Unicode-aware ``str.strip()``."""
    return F.regexp_replace(_c(c), F.lit(EDGE_WS), F.lit(""))


def norm_dedup(c) -> Column:
    """F1 normal form: strip, lower-case, whitespace runs -> one space."""
    return F.regexp_replace(strip_ws(F.lower(_c(c))), F.lit(WS_RUN), F.lit(" "))


def norm_cache(c) -> Column:
    """G1 normal form: strip, lower-case, every whitespace removed."""
    return F.regexp_replace(F.lower(_c(c)), F.lit(WS_RUN), F.lit(""))


def ws_split(c) -> Column:
    """``str.split()`` on an already-normalised string (no empty tokens)."""
    c = _c(c)
    return F.when(c == F.lit(""), F.array().cast("array<string>")) \
        .otherwise(F.split(c, F.lit(" ")))


def word_terms(c) -> Column:
    """Lower-cased word terms used by BM25 and the stand-in models."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(WORD_RUN), F.lit(0))


def tokens(c) -> Column:
    """Word tokens and punctuation marks, in text order."""
    return F.regexp_extract_all(_c(c), F.lit(TOKEN), F.lit(0))


def fingerprint(c) -> Column:
    """SHA-256 hex of the F1 normal form."""
    return F.sha2(norm_dedup(c), 256)


def portable_hash(c) -> Column:
    """31-bit hash equal in Spark and DuckDB: first 8 hex digits of md5, mod p."""
    return (F.conv(F.substring(F.md5(_c(c)), 1, 8), 16, 10).cast("bigint")
            % F.lit(2147483647))


def sorted_map_json(m) -> Column:
    """Compact JSON of a map with keys in sorted order (to_json keeps insertion order)."""
    m = _c(m)
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))
