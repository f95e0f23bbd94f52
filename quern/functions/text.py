"""Text scalars (native Column expressions).

Python's ``str.split()``/``strip()``/``\\s`` treat every Unicode
whitespace as a separator, Java's ``\\s`` only ASCII, and Spark's
``trim`` only the space.  All text rules here therefore use one explicit
whitespace class, written so that Java regex (Spark) and RE2 (DuckDB,
the oracle) read it the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the code points Python's str.isspace() accepts.
WS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")

# The same set as literal characters, for btrim (a native trim, no regex).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")

# Python ``\w`` on str: letters, numbers, underscore (combining marks excluded).
WORD = r"[\p{L}\p{N}_]+"

# Fixed value: stop words of the title key.
TITLE_STOP_WORDS = ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to",
                    "for", "of", "with", "by", "is", "are", "was", "were"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, however often ``use`` names it.

    Projections are merged by copying expressions, and branches of a
    condition share nothing; the only element of an array is made once.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def py_strip(s) -> Column:
    """``str.strip()``: drop leading/trailing Unicode whitespace."""
    return F.btrim(_c(s), F.lit(WS_CHARS))


def collapse_ws(s) -> Column:
    """``re.sub(r'\\s+', ' ', s).strip()``."""
    return py_strip(F.regexp_replace(_c(s), f"{WS}+", " "))


def words(s) -> Column:
    """``str.split()``: whitespace-separated tokens, empties dropped.

    Splitting the stripped text on whitespace runs yields no empty token
    (except for an all-blank text, handled apart), so no per-token filter.
    """
    t = py_strip(_c(s))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"{WS}+"))


def clip(s, n: int) -> Column:
    """Code-point prefix ``s[:n]``."""
    return F.substring(_c(s), 1, n)


def first_line(s) -> Column:
    return F.substring_index(_c(s), "\n", 1)


def content_fingerprint(text) -> Column:
    """C12 — md5 of (first 500 ‖ '||' ‖ last 200 ‖ '||' ‖ len div 100) of the
    lower-cased, whitespace-collapsed text; null for texts under 100 chars.
    """
    t = _c(text)

    def digest(clean):
        n = F.length(clean)
        tail = F.when(n > 200, F.substring(clean, -200, 200)).otherwise(F.lit(""))
        return F.md5(F.concat(F.substring(clean, 1, 500), F.lit("||"), tail, F.lit("||"),
                              F.floor(n / 100).cast("bigint").cast("string")))
    return F.when(t.isNull() | (F.length(t) < 100), F.lit(None).cast("string")).otherwise(once(collapse_ws(F.lower(t)), digest))


def title_words(title) -> Column:
    """``re.findall(r'\\w+', title.lower().strip())``."""
    return F.regexp_extract_all(py_strip(F.lower(F.coalesce(_c(title), F.lit("")))), F.lit(WORD), 0)


def title_key(title, stop_words=TITLE_STOP_WORDS) -> Column:
    """C13 — first five significant words (len > 3, not a stop word), sorted, space-joined."""
    stops = F.array(*[F.lit(w) for w in stop_words])
    sig = F.filter(title_words(title),
                   lambda w: (F.length(w) > 3) & ~F.array_contains(stops, w))
    return F.array_join(F.array_sort(F.slice(sig, 1, 5)), " ")
