"""C11 — extraction-quality grade as one native CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import WS, WS_CHARS, _c, once, words

# Boilerplate phrases that indicate a poor extraction.
BOILERPLATE = ["cookie", "privacy policy", "terms of service", "subscribe", "sign up",
               "log in", "login", "advertisement", "click here", "read more"]

# Numeric order of the grades.
QUALITY_RANK = {"high": 3, "medium": 2, "low": 1}


def long_lines(text) -> Column:
    """Number of '\\n'-separated lines whose stripped length exceeds 20."""
    lines = F.split(_c(text), "\n")
    return F.size(F.filter(lines, lambda l: F.length(F.btrim(l, F.lit(WS_CHARS))) > 20))


def boilerplate_hits(text, patterns=BOILERPLATE) -> Column:
    return once(F.lower(_c(text)), lambda low: sum((F.when(F.instr(low, p) > 0, 1).otherwise(0) for p in patterns), F.lit(0)))


NON_WS = "[^" + WS[1:-1] + "]+"


def word_count(text) -> Column:
    """len(text.split()) without building the array."""
    return F.regexp_count(F.coalesce(_c(text), F.lit("")), F.lit(NON_WS))


def distinct_word_ratio(text) -> Column:
    """len(set(text.split())) / len(text.split()); 0 for no words.

    The array of words is built once per row.
    """
    return once(words(F.coalesce(_c(text), F.lit(""))),
                lambda w: F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w)).otherwise(F.lit(0.0)))


def quality_grade(text, boilerplate=BOILERPLATE) -> Column:
    """C11 — high, medium or low. A text of 500 characters or fewer is low before anything is counted;
    of a longer one each measure is taken once."""
    t = _c(text)
    n = F.length(t)
    measures = F.struct(n.alias("n"), long_lines(t).alias("paras"), t.rlike("<[^>]+>").alias("html"),
                        boilerplate_hits(t, boilerplate).alias("poor"), distinct_word_ratio(t).alias("ratio"))
    grade = once(measures, lambda m: (
        F.when((m["n"] > 1500) & (m["paras"] >= 3) & ~m["html"] & (m["poor"] <= 1) & (m["ratio"] > 0.3), F.lit("high"))
        .when((m["paras"] >= 2) & (m["poor"] <= 2) & (m["ratio"] > 0.2), F.lit("medium")).otherwise(F.lit("low"))))
    return F.when(t.isNull() | (n <= 500), F.lit("low")).otherwise(grade)


def quality_rank(q) -> Column:
    """high=3, medium=2, anything else=1 (the reference's ``.get(q, 1)``)."""
    return once(_c(q), lambda g: F.when(g == "high", 3).when(g == "medium", 2).otherwise(1))
