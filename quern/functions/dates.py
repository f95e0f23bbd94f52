"""Date resolution scalars (C5–C8) as native Column expressions.

Every parse is a ``try_`` form (ANSI mode stays on): a bad value becomes
null and the cascade moves on, instead of failing the task.  Each
strptime-style format is guarded by the regex that Python's ``strptime``
would apply, so field widths and ranges agree exactly (Spark's ``M`` alone
would also accept ``003``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import WS, _c, once

# URL date layouts, tried in this order; the first match of
# each is validated (year 2000–2030, real calendar date) before moving on.
URL_DATE_PATTERNS = [
    r"/(\d{4})/(\d{1,2})/(\d{1,2})/",
    r"/(\d{4})-(\d{1,2})-(\d{1,2})/",
    r"(\d{4})(\d{2})(\d{2})",
    r"article(\d{8})",
    r"/(\d{2})-(\d{2})-(\d{4})/",
    r"/(\d{2})(\d{2})(\d{4})/",
    r"/news/(\d{4})/(\d{1,2})/(\d{1,2})/",
    r"(\d{1,2})_(\d{1,2})_(\d{4})",
    r"-(\d{4})(\d{2})(\d{2})-",
]

# strptime field regexes (Python's own definitions)
_D = r"(?:3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
_M = r"(?:1[0-2]|0[1-9]|[1-9])"
_Y = r"\d\d\d\d"
_H = r"(?:2[0-3]|[0-1]\d|\d)"
_MI = r"(?:[0-5]\d|\d)"
_S = r"(?:6[0-1]|[0-5]\d|\d)"
_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august",
           "september", "october", "november", "december"]
_B = "(?i:" + "|".join(_MONTHS) + ")"
_BB = "(?i:" + "|".join(m[:3] for m in _MONTHS) + ")"
_A = "(?i:mon|tue|wed|thu|fri|sat|sun)"

# The 13 formats of parse_date_any, in order, as
# (strptime format, guard regex, Spark pattern).
DATE_FORMATS = [
    ("%Y-%m-%d", f"{_Y}-{_M}-{_D}", "yyyy-M-d"),
    ("%d-%m-%Y", f"{_D}-{_M}-{_Y}", "d-M-yyyy"),
    ("%m/%d/%Y", f"{_M}/{_D}/{_Y}", "M/d/yyyy"),
    ("%d/%m/%Y", f"{_D}/{_M}/{_Y}", "d/M/yyyy"),
    ("%B %d, %Y", f"{_B} {_D}, {_Y}", "MMMM d, yyyy"),
    ("%d %B %Y", f"{_D} {_B} {_Y}", "d MMMM yyyy"),
    ("%b %d, %Y", f"{_BB} {_D}, {_Y}", "MMM d, yyyy"),
    ("%d %b %Y", f"{_D} {_BB} {_Y}", "d MMM yyyy"),
    ("%Y-%m-%d %H:%M:%S", f"{_Y}-{_M}-{_D} {_H}:{_MI}:{_S}", "yyyy-M-d H:m:s"),
    ("%d-%m-%Y %H:%M:%S", f"{_D}-{_M}-{_Y} {_H}:{_MI}:{_S}", "d-M-yyyy H:m:s"),
    ("%d %B, %Y", f"{_D} {_B}, {_Y}", "d MMMM, yyyy"),
    ("%B %d %Y", f"{_B} {_D} {_Y}", "MMMM d yyyy"),
    ("%d %b, %Y", f"{_D} {_BB}, {_Y}", "d MMM, yyyy"),
]


def _ymd_date(y: Column, m: Column, d: Column) -> Column:
    """Real calendar date from digit strings, else null (never throws)."""
    return F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-M-d")


def date_from_url(url) -> Column:
    """C5 — first valid date found by the nine URL layouts, else null."""
    u = F.coalesce(_c(url), F.lit(""))

    def layout(p):
        p = p.replace(r"\d", "[0-9]")

        def fields(found):  # the groups of a match are those of its own text
            if p.count("(") == 1:
                g = F.regexp_extract(found, p, 1)
                return F.struct(F.substring(g, 1, 4).alias("y"), F.substring(g, 5, 2).alias("m"), F.substring(g, 7, 2).alias("d"))
            g1, g2, g3 = (F.regexp_extract(found, p, i) for i in (1, 2, 3))
            return once(F.struct(g1.alias("a"), g2.alias("m"), g3.alias("b")), lambda g: F.struct(
                F.when(F.length(g["a"]) == 4, g["a"]).otherwise(g["b"]).alias("y"), g["m"].alias("m"),
                F.when(F.length(g["a"]) == 4, g["b"]).otherwise(g["a"]).alias("d")))
        # A layout without a match is searched for once, and no other field of it is made.
        return once(F.regexp_extract(u, p, 0), lambda found: F.when(found != "", once(fields(found), lambda g: F.when(
            (F.length(g["y"]) == 4) & g["y"].try_cast("int").between(2000, 2030), _ymd_date(g["y"], g["m"], g["d"])))))
    return F.coalesce(*[layout(p) for p in URL_DATE_PATTERNS])


def gmt_to_ist(published) -> Column:
    """C6 — RFC-822 'Www, dd Mon yyyy HH:MM:SS GMT' → IST 'yyyy-MM-dd HH:mm:ss';
    anything unparseable is returned unchanged."""
    p = _c(published)
    rx = rf"^{_A}, ({_D}) ({_BB}) ({_Y}) ({_H}:{_MI}:{_S}) (?:GMT|UTC)$"
    names = F.lit("".join(m[:3] for m in _MONTHS))

    def shifted(g):
        month = F.floor(F.instr(names, F.lower(g["name"])) / 3).cast("int") + 1
        # wall-clock arithmetic without a zone: a session zone with clock changes moves nothing
        ts = F.concat(g["year"], F.lit("-"), month.cast("string"), F.lit("-"), F.trim(g["day"]), F.lit(" "), g["time"]).try_cast("timestamp_ntz")
        return F.when(g["year"] != "", (ts + F.expr("INTERVAL 330 MINUTES")).cast("string"))
    parts = F.struct(*[F.regexp_extract(p, rx, i).alias(c) for i, c in enumerate(("day", "name", "year", "time"), 1)])
    return F.coalesce(once(parts, shifted), p)


def parse_ist(s) -> Column:
    """strptime(s, '%Y-%m-%d %H:%M:%S') as a timestamp, else null."""
    c = _c(s)
    ok = c.rlike(f"^{_Y}-{_M}-{_D} {_H}:{_MI}:{_S}$")
    return F.when(ok, F.try_to_timestamp(c, F.lit("yyyy-M-d H:m:s")))


# Characters kept by the date cleaner: Python's [\w\s\-:/,]
DATE_CLEAN = r"[^\p{L}\p{N}_" + WS[1:-1] + r"\-:/,]"


def clean_date_text(s) -> Column:
    """Drop characters outside ``[\\w\\s\\-:/,]`` and strip."""
    c = F.regexp_replace(F.coalesce(_c(s), F.lit("")), DATE_CLEAN, "")
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def parse_date_any(s) -> Column:
    """C7 — the 13 formats in order on the cleaned text (date part)."""
    c = clean_date_text(s)
    one = F.regexp_replace(c, f"{WS}+", " ")  # format spaces match any whitespace run
    tries = []
    for _, guard, pat in DATE_FORMATS:
        tries.append(F.when(one.rlike(f"^{guard}$"),
                            F.to_date(F.try_to_timestamp(F.trim(one), F.lit(pat)))))
    return F.coalesce(*tries)


def parse_relative_date(s, ref_date) -> Column:
    """C8 — 'today'/'0 day' → ref, 'yesterday'/'1 day' → ref−1, '2 day' → ref−2,
    only when 'ago' is present.  ``ref_date`` is a parameter, never now()."""
    low = F.lower(clean_date_text(s))
    ref = F.to_date(F.lit(ref_date)) if isinstance(ref_date, str) else _c(ref_date)
    has = lambda x: F.instr(low, x) > 0
    return (F.when(~has("ago"), F.lit(None).cast("date"))
            .when(has("today") | has("0 day"), ref)
            .when(has("yesterday") | has("1 day"), F.date_sub(ref, 1))
            .when(has("2 day"), F.date_sub(ref, 2)))


def parse_date_string(s, ref_date) -> Column:
    """C7 then C8: absolute formats first, relative phrases second."""
    return F.coalesce(parse_date_any(s), parse_relative_date(s, ref_date))
