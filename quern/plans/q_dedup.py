"""Dedup family queries: G1–G6, F8 and the flagship G5."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import dedup as D
from quern.plans import adapters as A
from quern.plans import oracle as O
from quern.plans.catalog import register

ART_OUT = ["doc_id", "title", "normalized_url", "extraction_quality", "state", "article_language"]
CARRY = ["doc_id", "title", "extraction_quality", "state", "article_language"]


def _out(df):
    return df.select(*ART_OUT, F.col("text_len").cast("bigint").alias("text_len"))


SQL_OUT = "SELECT a.doc_id, a.title, a.normalized_url, a.extraction_quality, a.state, a.article_language, " \
          "CAST(length(a.article_text) AS BIGINT) AS text_len FROM articles a"


def _smart_sql(mode: str) -> str:
    return (f"WITH {O.articles_cte()},\n{O.dedup_keys_cte()},\n{O.smart_dedup_ctes(mode)}\n"
            f"{SQL_OUT} WHERE a.seq IN (SELECT seq FROM s3)")


@register("smart_dedup", _smart_sql("best"), "G5")
def smart_dedup(spark, sf):
    return _out(D.smart_dedup(A.articles(spark, sf), "best", CARRY))


@register("smart_dedup_faithful", _smart_sql("faithful"), "G5/G2")
def smart_dedup_faithful(spark, sf):
    return _out(D.smart_dedup(A.articles(spark, sf), "faithful", CARRY))


def _stage_sql(stage: str, mode: str = "best") -> str:
    ctes = O.smart_dedup_ctes(mode)
    if stage == "url":
        sel = "s1"
        body = ctes
    else:
        # single stage on the full input: rename the input of that stage
        body = ctes.replace("FROM s1", "FROM keys").replace("FROM s2", "FROM keys")
        sel = "s2" if stage == "content" else "s3"
    return (f"WITH {O.articles_cte()},\n{O.dedup_keys_cte()},\n{body}\n"
            f"{SQL_OUT} WHERE a.seq IN (SELECT seq FROM {sel})")


@register("dedup_url_best", _stage_sql("url"), "G2")
def dedup_url_best(spark, sf):
    return _out(D.dedup_stage(A.articles(spark, sf), "url", "best", CARRY))


@register("dedup_url_faithful", _stage_sql("url", "faithful"), "G2")
def dedup_url_faithful(spark, sf):
    return _out(D.dedup_stage(A.articles(spark, sf), "url", "faithful", CARRY))


@register("dedup_content", _stage_sql("content"), "G3")
def dedup_content(spark, sf):
    return _out(D.dedup_stage(A.articles(spark, sf), "content", carry=CARRY))


@register("dedup_title", _stage_sql("title"), "G4")
def dedup_title(spark, sf):
    return _out(D.dedup_stage(A.articles(spark, sf), "title", carry=CARRY))


FUNNEL_SQL = (f"WITH {O.articles_cte()},\n{O.dedup_keys_cte()},\n{O.smart_dedup_ctes('best')}\n"
              "SELECT (SELECT count(*) FROM keys) AS original, (SELECT count(*) FROM s3) AS final, "
              "(SELECT count(*) FROM keys) - (SELECT count(*) FROM s1) AS removed_url, "
              "(SELECT count(*) FROM s1) - (SELECT count(*) FROM s2) AS removed_content, "
              "(SELECT count(*) FROM s2) - (SELECT count(*) FROM s3) AS removed_title, "
              "round_even(100.0 * ((SELECT count(*) FROM keys) - (SELECT count(*) FROM s3)) / "
              "(SELECT count(*) FROM keys), 2) AS removal_pct")


@register("dedup_funnel", FUNNEL_SQL, "F8")
def dedup_funnel(spark, sf):
    from quern.operators.aggs import dedup_funnel as funnel
    return funnel(D.dedup_chain(D.dedup_keys(A.articles(spark, sf)), "best"))


# G1 — repeated Link dropped, first row kept (exact Link, as the link writer does);
# the link rows repeat every 10th page later in the file.
def _g1_sql():
    from quern.plans.q_joins import LINKS_SQL
    return (f'SELECT seq, "Link" FROM (SELECT seq, "Link", row_number() OVER (PARTITION BY "Link" ORDER BY seq) AS rn '
            f'FROM {LINKS_SQL}) WHERE rn = 1')


@register("dedup_link_first", _g1_sql(), "G1")
def dedup_link_first(spark, sf):
    from quern.plans.q_joins import links
    return D.dedup_first(links(spark, sf).select("seq", "Link"), "Link")


# G6 — batches of 3 in page order per host; repeated lower(strip(url)) in a batch dropped.
@register("batch_dedup",
          "WITH p AS (SELECT page_id, url, " + O.domain("url") + " AS host, "
          "lower(" + O.strip("url") + ") AS k FROM pages), "
          "b AS (SELECT *, (row_number() OVER (PARTITION BY host ORDER BY page_id) - 1) // 3 AS batch FROM p) "
          "SELECT page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY host, batch, k ORDER BY page_id) AS rn "
          "FROM b) WHERE rn = 1", "G6")
def batch_dedup(spark, sf):
    from quern.functions.url import extract_domain
    p = (A.table(spark, sf, "pages").select(F.col("page_id").alias("seq"), "url")
         .withColumn("host", extract_domain("url")))
    return D.batch_dedup(p, "host", "url", 3).select(F.col("seq").alias("page_id"), "url")
