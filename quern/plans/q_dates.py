"""Date queries over ``orders`` rendered as feed entries: C5–C8, B6, B7, B12, B14, F9, F11."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import dates as Dt
from quern.operators import aggs as G
from quern.operators import filters as B
from quern.plans import adapters as A
from quern.plans import oracle as O
from quern.plans.catalog import register

START, END = "2000-06-01", "2000-12-31"
TERMS = ["urgent", "high", "specified"]
CONTEXT = ["1-", "2-"]

LINKS_SQL = """(SELECT seq, ts,
  (CASE WHEN seq % 50 = 0 THEN 'garbage ' || CAST(seq AS VARCHAR) ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT' END) AS published,
  'https://news' || CAST(seq % 7 AS VARCHAR) || '.example.in/' || (CASE seq % 9
    WHEN 0 THEN CAST(year(ts) AS VARCHAR) || '/' || CAST(month(ts) AS VARCHAR) || '/' || CAST(day(ts) AS VARCHAR) || '/story'
    WHEN 1 THEN CAST(year(ts) AS VARCHAR) || '-' || CAST(month(ts) AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR) || '/story'
    WHEN 2 THEN 'story' || strftime(ts, '%Y%m%d') || '.html'
    WHEN 3 THEN 'article' || strftime(ts, '%Y%m%d')
    WHEN 4 THEN strftime(ts, '%d-%m-%Y') || '/story'
    WHEN 5 THEN strftime(ts, '%d%m%Y') || '/story'
    WHEN 6 THEN 'news/' || CAST(year(ts) AS VARCHAR) || '/' || CAST(month(ts) AS VARCHAR) || '/' || CAST(day(ts) AS VARCHAR) || '/x'
    WHEN 7 THEN CAST(day(ts) AS VARCHAR) || '_' || CAST(month(ts) AS VARCHAR) || '_' || CAST(year(ts) AS VARCHAR)
    ELSE 'x-' || strftime(ts, '%Y%m%d') || '-y' END) AS link,
  o_orderpriority || ' ' || o_orderstatus AS title, 'total ' || CAST(o_totalprice AS VARCHAR) AS summary
FROM (SELECT o_orderkey AS seq, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts, o_orderpriority,
             o_orderstatus, o_totalprice FROM orders))"""


def links(spark, sf):
    return A.dated_links(spark, sf)


def _sql_url_date(u: str) -> str:
    outs = []
    for p in Dt.URL_DATE_PATTERNS:
        p = p.replace(r"\d", "[0-9]")
        if p.count("(") == 1:
            g = f"regexp_extract({u}, {O.lit(p)}, 1)"
            y, m, d = f"substring({g}, 1, 4)", f"substring({g}, 5, 2)", f"substring({g}, 7, 2)"
            ok = f"length({g}) = 8"
        else:
            g1, g2, g3 = (f"regexp_extract({u}, {O.lit(p)}, {i})" for i in (1, 2, 3))
            y = f"(CASE WHEN length({g1}) = 4 THEN {g1} ELSE {g3} END)"
            d = f"(CASE WHEN length({g1}) = 4 THEN {g3} ELSE {g1} END)"
            m = g2
            ok = f"(length({g1}) = 4 OR length({g3}) = 4)"
        outs.append(f"(CASE WHEN {ok} AND TRY_CAST({y} AS INTEGER) BETWEEN 2000 AND 2030 "
                    f"THEN CAST(try_strptime({y} || '-' || {m} || '-' || {d}, '%Y-%m-%d') AS DATE) END)")
    return "coalesce(" + ", ".join(outs) + ")"


def _sql_ist(p: str) -> str:
    rx = (r"^[A-Za-z]{3}, ((?:3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9]) [A-Za-z]{3} [0-9]{4} "
          r"(?:2[0-3]|[0-1][0-9]|[0-9]):(?:[0-5][0-9]|[0-9]):(?:6[0-1]|[0-5][0-9]|[0-9])) (?:GMT|UTC)$")
    m = f"regexp_extract({p}, {O.lit(rx)}, 1)"
    ts = f"try_strptime({m}, '%d %b %Y %H:%M:%S')"
    return f"(CASE WHEN {m} <> '' AND {ts} IS NOT NULL THEN strftime({ts} + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') ELSE {p} END)"


@register("date_from_url", f"SELECT seq, {_sql_url_date('link')} AS url_date FROM {LINKS_SQL}", "C5")
def date_from_url(spark, sf):
    return links(spark, sf).select("seq", Dt.date_from_url("link").alias("url_date"))


@register("gmt_to_ist", f"SELECT seq, {_sql_ist('published')} AS ist FROM {LINKS_SQL}", "C6")
def gmt_to_ist(spark, sf):
    return links(spark, sf).select("seq", Dt.gmt_to_ist("published").alias("ist"))


# C7 — order dates rendered in the 13 layouts (plus stray symbols and spaces)
RENDER_SQL = """(SELECT o_orderkey AS seq, CASE o_orderkey % 14
  WHEN 0 THEN strftime(o_orderdate, '%Y-%-m-%-d') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y')
  WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN 4 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 5 THEN strftime(o_orderdate, '%-d %B %Y')
  WHEN 6 THEN strftime(o_orderdate, '%b %d, %Y') WHEN 7 THEN '• ' || strftime(o_orderdate, '%-d %b %Y') || ' •'
  WHEN 8 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 9 THEN strftime(o_orderdate, '%d-%m-%Y %H:%M:%S')
  WHEN 10 THEN strftime(o_orderdate, '%-d %B,  %Y') WHEN 11 THEN lower(strftime(o_orderdate, '%B %-d %Y'))
  WHEN 12 THEN strftime(o_orderdate, '%-d %b, %Y') ELSE strftime(o_orderdate, '%Y/%m/%d') END AS s FROM orders)"""


def rendered(spark, sf):
    o = A.table(spark, sf, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 14
    fmt = lambda p: F.date_format(d, p)
    s = (F.when(k == 0, fmt("yyyy-M-d")).when(k == 1, fmt("dd-MM-yyyy")).when(k == 2, fmt("M/d/yyyy"))
         .when(k == 3, fmt("dd/MM/yyyy")).when(k == 4, fmt("MMMM d, yyyy")).when(k == 5, fmt("d MMMM yyyy"))
         .when(k == 6, fmt("MMM dd, yyyy")).when(k == 7, F.concat(F.lit("• "), fmt("d MMM yyyy"), F.lit(" •")))
         .when(k == 8, fmt("yyyy-MM-dd HH:mm:ss")).when(k == 9, fmt("dd-MM-yyyy HH:mm:ss"))
         .when(k == 10, fmt("d MMMM,  yyyy")).when(k == 11, F.lower(fmt("MMMM d yyyy")))
         .when(k == 12, fmt("d MMM, yyyy")).otherwise(fmt("yyyy/MM/dd")))
    return o.select(F.col("o_orderkey").alias("seq"), s.alias("s"))


def _sql_parse_any(s: str) -> str:
    from quern.functions.text import WS
    clean = O.strip(f"regexp_replace(coalesce({s}, ''), {O.lit(Dt.DATE_CLEAN)}, '', 'g')")
    one = f"regexp_replace({clean}, '{WS}+', ' ', 'g')"
    outs = [f"(CASE WHEN regexp_matches({one}, {O.lit('^' + guard + '$')}) THEN CAST(try_strptime({one}, {O.lit(fmt)}) AS DATE) END)"
            for fmt, guard, _ in Dt.DATE_FORMATS]
    return "coalesce(" + ", ".join(outs) + ")"


@register("parse_date_any", f"SELECT seq, s, {_sql_parse_any('s')} AS parsed FROM {RENDER_SQL}", "C7")
def parse_date_any(spark, sf):
    r = rendered(spark, sf)
    return r.select("seq", "s", Dt.parse_date_any("s").alias("parsed"))


def _sql_status() -> str:
    ist = _sql_ist("published")
    ts = f"(CASE WHEN regexp_matches({ist}, '^[0-9]{{4}}-(?:1[0-2]|0[1-9]|[1-9])-(?:3[01]|[12][0-9]|0[1-9]|[1-9]) [0-9:]+$') THEN try_strptime({ist}, '%Y-%m-%d %H:%M:%S') END)"
    url_d = _sql_url_date("link")
    ok = f"({url_d} BETWEEN DATE '{START}' AND DATE '{END}')"
    return f"""(SELECT *, (CASE WHEN {ts} IS NOT NULL AND CAST({ts} AS DATE) BETWEEN DATE '{START}' AND DATE '{END}' THEN 'in_range'
   WHEN {ts} IS NOT NULL AND coalesce({ok}, false) THEN 'url_rescued'
   WHEN {ts} IS NOT NULL THEN 'out_of_range'
   WHEN coalesce({ok}, false) THEN 'parse_error_rescued' ELSE 'parse_error' END) AS date_status,
   {ist} AS ist0, {url_d} AS url_d, CAST({ts} AS DATE) AS d0 FROM {LINKS_SQL})"""


STATUS_SQL = _sql_status()
KEPT_SQL = (f"(SELECT seq, date_status, CASE WHEN date_status = 'in_range' THEN d0 ELSE url_d END AS article_date, "
            f"CASE WHEN date_status = 'in_range' THEN ist0 ELSE strftime(url_d, '%Y-%m-%d') || ' 12:00:00' END AS ist_date, "
            f"title, summary, link FROM {STATUS_SQL} WHERE date_status IN ('in_range', 'url_rescued', 'parse_error_rescued'))")


@register("strict_date_filter", f"SELECT seq, date_status, article_date, ist_date FROM {KEPT_SQL}", "B6")
def strict_date_filter(spark, sf):
    d = B.strict_date_filter(links(spark, sf), START, END)
    return d.where(F.col("article_date").isNotNull()).select("seq", "date_status", "article_date", "ist_date")


COMBINED = "(title || ' ' || summary)"


def _rel(x: str) -> str:
    return O.relevant(x, TERMS, None, CONTEXT)


@register("collect_entries",
          f"SELECT title AS \"Title\", link AS \"Link\", ist_date AS \"Date\", '' AS \"Source\", summary AS \"Summary\", "
          f"'Monsoon' AS \"Term\", 'en' AS \"LanguageQueried\" FROM {KEPT_SQL} "
          f"WHERE {_rel('title')} AND {_rel(COMBINED)}", "B7")
def collect_entries(spark, sf):
    return B.collect_entries(links(spark, sf), TERMS, START, END, "Monsoon", "en", context=CONTEXT)


COLLECT_LINKS_SQL = (f"SELECT DISTINCT link AS \"Link\" FROM {KEPT_SQL} WHERE {_rel('title')} AND {_rel(COMBINED)}")


@register("drop_bad_dates",
          f"SELECT seq, {_sql_ist('published')} AS \"Date\" FROM {LINKS_SQL} "
          f"WHERE TRY_CAST({_sql_ist('published')} AS TIMESTAMP) IS NOT NULL", "B12")
def drop_bad_dates(spark, sf):
    d = links(spark, sf).select("seq", Dt.gmt_to_ist("published").alias("Date"))
    return B.drop_bad_dates(d, "Date")


@register("coarse_lookback",
          "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= CAST(DATE '1998-08-02' - INTERVAL 37 DAY AS TIMESTAMP)",
          "B14")
def coarse_lookback(spark, sf):
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return B.coarse_lookback(o, "o_orderdate", "1998-08-02", 30)


@register("rejection_funnel",
          f"""SELECT count(*) FILTER (WHERE NOT {_rel('title')}) + count(*) FILTER (WHERE {_rel('title')}
                AND date_status IN ('in_range', 'url_rescued', 'parse_error_rescued')
                AND NOT {_rel(COMBINED)}) AS content_rejected,
              count(*) FILTER (WHERE {_rel('title')} AND date_status = 'out_of_range') AS out_of_range,
              count(*) FILTER (WHERE {_rel('title')} AND date_status IN ('parse_error', 'parse_error_rescued')) AS parse_error
              FROM {STATUS_SQL}""", "F9")
def rejection_funnel(spark, sf):
    return G.rejection_funnel(links(spark, sf), TERMS, START, END, context=CONTEXT)


@register("dates_present",
          f"SELECT array_to_string(list_sort(list(DISTINCT strftime(article_date, '%Y-%m-%d'))), ',') AS dates FROM {KEPT_SQL}",
          "F11")
def dates_present(spark, sf):
    d = B.strict_date_filter(links(spark, sf), START, END).where(F.col("article_date").isNotNull())
    return G.dates_present(d, "article_date")


# Phrases of relative dates, dealt to the orders by their key.
RELATIVE = ["today, updated 1 hour ago", "Posted Yesterday ago", "2 days ago", "1 day ago", "0 day ago", "21 days ago", "3 weeks ago", "today"]


@register("parse_relative_date",
          f"""SELECT o_orderkey, CASE WHEN position('ago' IN p) = 0 THEN NULL
                WHEN contains(p, 'today') OR contains(p, '0 day') THEN CAST(o_orderdate AS DATE)
                WHEN contains(p, 'yesterday') OR contains(p, '1 day') THEN CAST(o_orderdate AS DATE) - 1
                WHEN contains(p, '2 day') THEN CAST(o_orderdate AS DATE) - 2 END AS day
              FROM (SELECT o_orderkey, o_orderdate, lower([{', '.join(O.lit(x) for x in RELATIVE)}][CAST(o_orderkey % 8 AS INTEGER) + 1]) AS p
                    FROM orders)""", "C8")
def parse_relative_date(spark, sf):
    o = A.table(spark, sf, "orders")
    text = F.try_element_at(F.array(*[F.lit(x) for x in RELATIVE]), (F.col("o_orderkey") % 8).cast("int") + 1)
    return o.select("o_orderkey", Dt.parse_relative_date(text, F.to_date("o_orderdate")).alias("day"))
