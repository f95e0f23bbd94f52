"""Script-based language identification and language lookups.

Counting characters of a script is a regex delete + length difference.
All eight Indic scripts live in U+0900–U+0D7F, so the text is first
reduced to that block once; for Latin text the residue is empty and the
eight per-script counts cost nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.dims.languages import LANGUAGE_NAMES, NEWSPAPER_LANGUAGE, PRIMARY_LANGUAGE, REGION_LANGUAGES
from quern.functions.text import WS, _c

# Script blocks tested, in the reference's order.
SCRIPTS = [("hi", 0x0900, 0x097F), ("bn", 0x0980, 0x09FF), ("ta", 0x0B80, 0x0BFF),
           ("te", 0x0C00, 0x0C7F), ("kn", 0x0C80, 0x0CFF), ("ml", 0x0D00, 0x0D7F),
           ("gu", 0x0A80, 0x0AFF), ("pa", 0x0A00, 0x0A7F)]

INDIC_BLOCK = r"[^\x{0900}-\x{0D7F}]"
# Characters that are *not* counted as non-Latin: ASCII letters, whitespace,
# digits (Python isdigit: Nd plus super/subscript digits) and . , ; : ! ? ' " ( ) [ ] { }
LATINISH = (r"[A-Za-z\p{Nd}\x{00B2}\x{00B3}\x{00B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
            r".,;:!?'\"()\[\]{}" + WS[1:-1] + "]")


def _block(lo: int, hi: int) -> str:
    return f"[\\x{{{lo:04X}}}-\\x{{{hi:04X}}}]"


def indic_residue(text) -> Column:
    """The text reduced to the U+0900–U+0D7F block (usually empty)."""
    return F.regexp_replace(F.coalesce(_c(text), F.lit("")), INDIC_BLOCK, "")


def script_counts(text, residue=None) -> dict[str, Column]:
    residue = indic_residue(text) if residue is None else _c(residue)
    n = F.length(residue)
    return {lang: n - F.length(F.regexp_replace(residue, _block(lo, hi), "")) for lang, lo, hi in SCRIPTS}


def script_language_first(text, residue=None) -> Column:
    """C9 — first script (in listed order) above 15 % of the characters; else en.

    ``residue`` (``indic_residue(text)``) may be passed precomputed, so one
    reduction of a long text serves every script count."""
    t = F.coalesce(_c(text), F.lit(""))
    n = F.length(t)
    counts = script_counts(t, residue)
    expr = F.when(n < 50, F.lit("en"))
    for lang, _, _ in SCRIPTS:
        expr = expr.when(counts[lang] > n * 0.15, F.lit(lang))
    return expr.otherwise(F.lit("en"))


def non_latin_count(text) -> Column:
    t = F.coalesce(_c(text), F.lit(""))
    return F.length(F.regexp_replace(t, LATINISH, ""))


def script_language_dominant(text, residue=None, non_latin=None) -> Column:
    """C10 — if >15 % non-Latin and the largest script >10 %: that script; else en."""
    t = F.coalesce(_c(text), F.lit(""))
    n = F.length(t)
    counts = script_counts(t, residue)
    top = F.greatest(*counts.values())
    pick = F.lit("en")
    for lang, _, _ in reversed(SCRIPTS):  # first listed wins a tie
        pick = F.when(counts[lang] == top, F.lit(lang)).otherwise(pick)
    return (F.when(n < 50, F.lit("en"))
            .when(((non_latin_count(t) if non_latin is None else _c(non_latin)) > n * 0.15) & (top > n * 0.1), pick)
            .otherwise(F.lit("en")))


def language_code(name) -> Column:
    """C17 — first language name contained in lower(name); default en."""
    low = F.lower(F.coalesce(_c(name), F.lit("")))
    expr = None
    for lang_name, code in NEWSPAPER_LANGUAGE:
        cond = F.instr(low, lang_name) > 0
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit("en"))


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def primary_language(region) -> Column:
    """C18 — region → primary language code, default en."""
    return F.coalesce(F.try_element_at(_map(PRIMARY_LANGUAGE), _c(region)), F.lit("en"))


def region_languages(region) -> Column:
    """C18 — region → ordered language codes, default [en]."""
    m = F.create_map(*[x for r, ls in REGION_LANGUAGES.items()
                       for x in (F.lit(r), F.array(*[F.lit(v) for v in ls]))])
    return F.coalesce(F.try_element_at(m, _c(region)), F.array(F.lit("en")))


def language_name(code) -> Column:
    """C18 — code → display name, default the code itself."""
    return F.coalesce(F.try_element_at(_map(LANGUAGE_NAMES), _c(code)), _c(code))


def region_display(region) -> Column:
    """C19 — 'west-bengal' → 'West Bengal'."""
    return F.initcap(F.replace(_c(region), F.lit("-"), F.lit(" ")))
