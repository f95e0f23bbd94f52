"""Request-error classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import _c

# Ordered keyword groups → error class.
ERROR_CLASSES = [
    ("rate_limit", ["max retries", "retries exceeded"]),
    ("ssl_error", ["ssl", "eof", "certificate"]),
    ("connection_error", ["connection", "remotedisconnected", "connectionerror"]),
    ("timeout_error", ["timeout", "timed out"]),
    ("access_denied", ["forbidden", "403", "blocked"]),
    ("not_found", ["not found", "404"]),
]

# Substrings that make an error fatal (matched case-sensitively).
FATAL_INDICATORS = ["forbidden", "403", "access denied", "authentication",
                    "invalid api key", "quota exceeded permanently"]


def classify_error(err) -> Column:
    """C20 — first keyword group found in lower(err); else unknown_error."""
    low = F.lower(F.coalesce(_c(err), F.lit("")))
    expr = None
    for cls, words in ERROR_CLASSES:
        cond = F.lit(False)
        for w in words:
            cond = cond | (F.instr(low, w) > 0)
        expr = F.when(cond, F.lit(cls)) if expr is None else expr.when(cond, F.lit(cls))
    return expr.otherwise(F.lit("unknown_error"))


def is_fatal_error(err) -> Column:
    """C21 — any fatal indicator present (case-sensitive, as written)."""
    e = F.coalesce(_c(err), F.lit(""))
    cond = F.lit(False)
    for w in FATAL_INDICATORS:
        cond = cond | (F.instr(e, w) > 0)
    return cond
