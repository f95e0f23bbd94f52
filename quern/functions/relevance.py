"""Keyword relevance (B5) and term hits (C15) over an array of terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import _c

# Phrases that mark clearly irrelevant content.
IRRELEVANT = ["fashion", "beauty", "recipe", "cooking", "sports score", "cricket", "football",
              "entertainment", "celebrity", "movie release", "film", "music album",
              "festival celebration", "wedding", "marriage ceremony", "astrology", "horoscope",
              "stock market", "share price", "investment", "real estate deal", "property sale"]

# Generic context words that back up a single keyword hit.
CONTEXT = ["weather", "government", "alert", "warning", "rescue", "relief", "help",
           "damage", "affected", "impact", "water", "river", "road", "house",
           "people", "area", "district", "village", "city", "state"]


def _terms(terms) -> Column:
    if isinstance(terms, Column):
        return terms
    return F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")


def term_hits(text, terms) -> Column:
    """C15 — the terms (list order, repeats kept) found in lower(text)."""
    low = F.array(F.lower(F.coalesce(_c(text), F.lit(""))))
    # the lowered text is the (only) element of the outer array, so it is made once a row
    return F.flatten(F.transform(low, lambda x: F.filter(_terms(terms), lambda t: F.instr(x, F.lower(t)) > 0)))


def count_present(low: Column, phrases) -> Column:
    return sum((F.when(F.instr(low, p) > 0, 1).otherwise(0) for p in phrases), F.lit(0))


def is_relevant(text, terms, irrelevant=IRRELEVANT, context=CONTEXT) -> Column:
    """B5 — ≥1 term, ≤2 irrelevant phrases, and (≥2 terms or ≥1 context word)."""
    t = _c(text)
    low = F.lower(F.coalesce(t, F.lit("")))
    arr = _terms(terms)
    m = F.size(term_hits(t, arr))
    return (F.when(t.isNull() | (t == "") | (F.coalesce(F.size(arr), F.lit(0)) <= 0), F.lit(False))
            .when(m == 0, F.lit(False))
            .when(count_present(low, irrelevant) > 2, F.lit(False))
            .when(m >= 2, F.lit(True))
            .otherwise(count_present(low, context) >= 1))


def relevance_reason(text, terms, irrelevant=IRRELEVANT, context=CONTEXT) -> Column:
    """Which B5 branch decided: none / irrelevant / multi / single_context / single_no_context."""
    t = _c(text)
    low = F.lower(F.coalesce(t, F.lit("")))
    arr = _terms(terms)
    m = F.size(term_hits(t, arr))
    return (F.when(t.isNull() | (t == "") | (F.coalesce(F.size(arr), F.lit(0)) <= 0), F.lit("empty"))
            .when(m == 0, F.lit("none"))
            .when(count_present(low, irrelevant) > 2, F.lit("irrelevant"))
            .when(m >= 2, F.lit("multi"))
            .when(count_present(low, context) >= 1, F.lit("single_context"))
            .otherwise(F.lit("single_no_context")))
