"""URL queries over ``pages``: C1–C4, C14, C16, B1–B4, F13, H6."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import url as U
from quern.operators import aggs as G
from quern.operators import filters as B
from quern.plans import adapters as A
from quern.plans import oracle as O
from quern.plans.catalog import register


def pages_urls(spark, sf):
    """pages ∪ the same pages with tracking noise and a Google RSS form, so
    canonicalisation, dedup and the Google branch all see collisions."""
    p = A.table(spark, sf, "pages").select(F.lit(0).alias("variant"), "page_id", "url")
    noisy = p.select(F.lit(1).alias("variant"), "page_id",
                     F.concat(F.regexp_replace("url", "#.*$", ""),
                              F.when(F.instr("url", "?") > 0, F.lit("&")).otherwise(F.lit("?")),
                              F.lit("utm_medium=x&fbclid=1&k=a%20b&k=c+d&e=&z=%7E*/#frag")).alias("url"))
    google = p.where(F.col("page_id") % 5 == 0).select(
        F.lit(2).alias("variant"), "page_id",
        F.concat(F.lit("https://news.google.com/rss/articles/CBMi"), F.md5(F.col("url")),
                 F.when(F.col("page_id") % 2 == 0, F.md5(F.concat(F.col("url"), F.lit("x")))).otherwise(F.lit("")),
                 F.when(F.col("page_id") % 2 == 0, F.md5(F.concat(F.col("url"), F.lit("y")))).otherwise(F.lit("")),
                 F.when(F.col("page_id") % 2 == 0, F.md5(F.concat(F.col("url"), F.lit("z")))).otherwise(F.lit("")),
                 F.lit("?oc=5")).alias("url"))
    social = p.where(F.col("page_id") % 7 == 0).select(
        F.lit(3).alias("variant"), "page_id",
        F.concat(F.lit(" https://www.facebook.com/share?u="), F.col("page_id").cast("string"), F.lit(" ")).alias("url"))
    return p.unionByName(noisy).unionByName(google).unionByName(social)


PAGES_URLS_SQL = """(SELECT 0 AS variant, page_id, url FROM pages
 UNION ALL SELECT 1, page_id, regexp_replace(url, '#.*$', '') || (CASE WHEN position('?' IN url) > 0 THEN '&' ELSE '?' END)
   || 'utm_medium=x&fbclid=1&k=a%20b&k=c+d&e=&z=%7E*/#frag' FROM pages
 UNION ALL SELECT 2, page_id, 'https://news.google.com/rss/articles/CBMi' || md5(url)
   || (CASE WHEN page_id % 2 = 0 THEN md5(url || 'x') || md5(url || 'y') || md5(url || 'z') ELSE '' END) || '?oc=5'
   FROM pages WHERE page_id % 5 = 0
 UNION ALL SELECT 3, page_id, ' https://www.facebook.com/share?u=' || CAST(page_id AS VARCHAR) || ' '
   FROM pages WHERE page_id % 7 = 0)"""


@register("normalize_url",
          f"SELECT variant, page_id, {O.normalize_url('url')} AS normalized_url, {O.domain('url')} AS domain, "
          f"{O.main_domain(O.domain('url'))} AS main_domain, regexp_extract(url, '/articles/([^?]+)', 1) AS google_id, "
          f"md5({O.normalize_url('url')} || 'title') AS article_id FROM {PAGES_URLS_SQL}", "C1-C4/C14")
def normalize_url(spark, sf):
    u = pages_urls(spark, sf)
    d = U.extract_domain("url")
    return u.select("variant", "page_id", U.normalize_url("url").alias("normalized_url"), d.alias("domain"),
                    U.extract_main_domain(d).alias("main_domain"), U.google_article_id("url").alias("google_id"),
                    U.article_id(U.normalize_url("url"), F.lit("title")).alias("article_id"))


@register("url_predicates",
          f"SELECT variant, page_id, {O.valid_link('url')} AS valid, {O.problematic('url')} AS problematic, "
          f"{O.should_skip('url')} AS skip FROM {PAGES_URLS_SQL}", "B1-B3")
def url_predicates(spark, sf):
    u = pages_urls(spark, sf)
    return u.select("variant", "page_id", U.valid_link("url").alias("valid"), U.is_problematic_url("url").alias("problematic"),
                    U.should_skip_url("url").alias("skip"))


@register("path_similarity",
          f"SELECT page_id, {O.path_similarity('url', 'other')} AS sim FROM (SELECT p.page_id, p.url, q.url AS other "
          f"FROM {PAGES_URLS_SQL} p JOIN {PAGES_URLS_SQL} q ON q.page_id = p.page_id AND p.variant = 0 AND q.variant = 1)", "C16")
def path_similarity(spark, sf):
    u = pages_urls(spark, sf)
    o = u.where("variant = 1").select("page_id", F.col("url").alias("other"))
    return u.where("variant = 0").join(o, "page_id").select("page_id", U.path_similarity("url", "other").alias("sim"))


# B4 — one "CSV" per host; problematic = long Google RSS / social links.
CAP_SQL = f"""WITH u AS (SELECT variant * 4 + page_id * 16 AS seq, variant, page_id, url, {O.domain("url")} AS host0 FROM {PAGES_URLS_SQL}),
v AS (SELECT seq, page_id, url, (CASE WHEN host0 = 'news.google.com' OR host0 = 'facebook.com'
        THEN 'g' || CAST(page_id % 3 AS VARCHAR) ELSE 'h' || CAST(page_id % 3 AS VARCHAR) END) AS csv,
        {O.problematic('url')} AS prob FROM u),
w AS (SELECT *, count(*) OVER (PARTITION BY csv) AS n,
        row_number() OVER (PARTITION BY csv, prob ORDER BY seq) AS rn FROM v)
SELECT seq, csv, prob AS is_problematic FROM w WHERE NOT prob OR rn <= floor(n * 0.2)"""


def _cap_input(spark, sf):
    u = pages_urls(spark, sf)
    host = U.extract_domain("url")
    csv = F.when(host.isin("news.google.com", "facebook.com"), F.concat(F.lit("g"), (F.col("page_id") % 3).cast("string"))) \
        .otherwise(F.concat(F.lit("h"), (F.col("page_id") % 3).cast("string")))
    return u.select((F.col("variant") * 4 + F.col("page_id") * 16).alias("seq"), "url", csv.alias("csv"))


@register("cap_problematic", CAP_SQL, "B4")
def cap_problematic(spark, sf):
    out = B.cap_problematic(_cap_input(spark, sf), "csv", "url", 0.2)
    return out.select("seq", "csv", "is_problematic")


@register("url_filter_counts",
          f"SELECT count(*) FILTER (WHERE NOT {O.valid_link('url')}) AS invalid, "
          f"count(*) FILTER (WHERE {O.valid_link('url')} AND NOT {O.problematic('url')}) AS clean, "
          f"count(*) FILTER (WHERE {O.valid_link('url')} AND {O.problematic('url')}) AS problematic, "
          f"(SELECT count(*) FROM ({CAP_SQL})) AS kept FROM {PAGES_URLS_SQL}", "F13")
def url_filter_counts(spark, sf):
    u = pages_urls(spark, sf)
    kept = B.cap_problematic(_cap_input(spark, sf), "csv", "url", 0.2)
    return G.url_filter_counts(u, kept)


@register("distinct_links",
          f"SELECT DISTINCT {O.normalize_url('url')} AS link FROM {PAGES_URLS_SQL}", "H6")
def distinct_links(spark, sf):
    return pages_urls(spark, sf).select(U.normalize_url("url").alias("link")).dropDuplicates()
