"""Page-extraction queries over ``pages``: D1–D6, B11, H4."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import pages as P
from quern.plans import adapters as A
from quern.plans import oracle as O
from quern.plans.catalog import register

LINK_TERMS = ["thble", "thtion", "thing", "the", "attion"]
RUN_DATE = "2024-01-31"


def parsed(spark, sf):
    return P.parse_pages(A.table(spark, sf, "pages"), LINK_TERMS)


def _text(x: str) -> str:
    """Tag-stripped, entity-decoded, stripped text of an HTML fragment."""
    t = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]:
        t = f"replace({t}, {O.lit(a)}, {O.lit(b)})"
    return O.strip(t)


def _title_sql() -> str:
    h1s = f"list_transform(regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), lambda h: {_text('h')})"
    h1 = f"list_filter({h1s}, lambda h: length(h) > 10 AND length(h) < 200)[1]"
    t = _text("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")
    for suf in P.TITLE_SUFFIXES:
        t = f"regexp_replace({t}, {O.lit(chr(92) + 'Q' + suf + chr(92) + 'E$')}, '')"
    return (f"coalesce({h1}, CASE WHEN regexp_matches(html, '<title') AND length({t}) > 10 THEN {t} END)")


@register("page_title", f"SELECT page_id, {_title_sql()} AS page_title FROM pages", "D1")
def page_title(spark, sf):
    p = parsed(spark, sf)
    return p.select("page_id", P.page_title(p).alias("page_title"))


@register("page_fields", None, "D1-D4/D6/C10")
def page_fields(spark, sf):
    return P.page_fields(parsed(spark, sf), RUN_DATE).select(
        "page_id", "page_title", "summary", "page_date", "body", "rendered_body", "body_language")


@register("page_links_all", None, "D5/H6")
def page_links_all(spark, sf):
    return P.page_links(parsed(spark, sf), LINK_TERMS, RUN_DATE)


@register("page_links", None, "H4")
def page_links(spark, sf):
    return P.first_n(P.page_links(parsed(spark, sf), LINK_TERMS, RUN_DATE), 4)


@register("validate_page_article", None, "B11")
def validate_page_article(spark, sf):
    # dated pages: the URL carries a day of January to March, so the window cuts two thirds
    dated = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/2024/"), (F.col("page_id") % 3 + 1).cast("string"), F.lit("/"),
                     (F.col("page_id") % 28 + 1).cast("string"), F.lit("/"))
    f = P.page_fields(parsed(spark, sf).withColumn("url", dated), RUN_DATE)
    return P.validate_page_article(f, ["the", "thing"], "2024-01-01", RUN_DATE, context=["and"])
