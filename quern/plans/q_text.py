"""Text scalar and corpus-statistics queries over ``documents``.

C9–C13, C15, C23, B5, B8, B9, E5, F1–F7, H1, H2, H5.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.dims.languages import ENGLISH_TERMS
from quern.functions import lang as L
from quern.functions import quality as Q
from quern.functions import relevance as R
from quern.functions import text as T
from quern.operators import aggs as G
from quern.operators import dedup as D
from quern.operators import filters as B
from quern.operators import joins as J
from quern.operators.common import materialize
from quern.plans import adapters as A
from quern.plans import oracle as O
from quern.plans.catalog import register

# Parameters that reach every B5 branch on the synthetic prose.
DOC_TERMS = ["thble", "thtion", "thing", "attion", "erble"]
DOC_IRRELEVANT = ["ering", "oning", "ontion", "retion"]
DOC_CONTEXT = ["und"]
LICENSE_BOILERPLATE = ["apache license", "mit license", "copyright", "all rights reserved"]

def docs(spark, sf):
    return A.table(spark, sf, "documents")


# ------------------------------------------------------------------ C11 quality

@register("quality_grade",
          "SELECT doc_id, " + O.quality("text") + " AS extraction_quality, "
          "CAST(length(text) AS BIGINT) AS n_chars, "
          "CAST(len(list_filter(string_split(text, chr(10)), lambda l: length(" + O.strip("l") + ") > 20)) AS BIGINT) AS n_long_lines, "
          "regexp_matches(text, '<[^>]+>') AS has_html FROM documents", "C11")
def quality_grade(spark, sf):
    d = docs(spark, sf)
    return d.select("doc_id", Q.quality_grade("text").alias("extraction_quality"),
                    F.length("text").cast("bigint").alias("n_chars"),
                    Q.long_lines("text").cast("bigint").alias("n_long_lines"),
                    F.col("text").rlike("<[^>]+>").alias("has_html"))


@register("quality_grade_licenses",
          "SELECT doc_id, " + O.quality("text", LICENSE_BOILERPLATE) + " AS extraction_quality FROM documents", "C11")
def quality_grade_licenses(spark, sf):
    return docs(spark, sf).select("doc_id", Q.quality_grade("text", LICENSE_BOILERPLATE).alias("extraction_quality"))


@register("quality_grade_pages",
          "SELECT page_id, " + O.quality("html") + " AS extraction_quality FROM pages", "C11")
def quality_grade_pages(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", Q.quality_grade("html").alias("extraction_quality"))


# ------------------------------------------------------------------ C12 / C13 / C23

@register("content_fingerprint",
          "SELECT doc_id, " + O.fingerprint("text") + " AS content_fp FROM documents", "C12")
def content_fingerprint(spark, sf):
    return docs(spark, sf).select("doc_id", T.content_fingerprint("text").alias("content_fp"))


@register("title_key",
          "SELECT doc_id, " + O.title_key("split_part(text, chr(10), 1)") + " AS title_key, "
          "CAST(len(regexp_extract_all(" + O.strip("lower(split_part(text, chr(10), 1))")
          + ", '" + T.WORD + "')) AS BIGINT) AS n_words FROM documents", "C13")
def title_key(spark, sf):
    title = T.first_line("text")
    return docs(spark, sf).select("doc_id", T.title_key(title).alias("title_key"),
                                  F.size(T.title_words(title)).cast("bigint").alias("n_words"))


@register("clip_text",
          "SELECT doc_id, substring(text, 1, 300) AS summary, substring(text, 1, 200) AS row_text FROM documents",
          "C23")
def clip_text(spark, sf):
    return docs(spark, sf).select("doc_id", T.clip("text", 300).alias("summary"), T.clip("text", 200).alias("row_text"))


# ------------------------------------------------------------------ C9 / C10

LANG_SRC = ("SELECT 'document' AS kind, doc_id AS id, NULL AS turn, text FROM documents UNION ALL "
            "SELECT 'conversation' AS kind, conv_id AS id, turn, text FROM conversations")


@register("script_language",
          f"SELECT kind, id, turn, {O.lang_first('text')} AS lang_first, {O.lang_dominant('text')} AS lang_dominant, "
          f"CAST(length(regexp_replace(coalesce(text, ''), {O.lit(L.LATINISH)}, '', 'g')) AS BIGINT) AS non_latin "
          f"FROM ({LANG_SRC})", "C9/C10")
def script_language(spark, sf):
    c = A.table(spark, sf, "conversations")
    c = c.select(F.lit("conversation").alias("kind"), F.col("conv_id").alias("id"), "turn", "text")
    d = docs(spark, sf).select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"),
                               F.lit(None).cast(c.schema["turn"].dataType).alias("turn"), "text")
    u = materialize(d.unionByName(c), _res=L.indic_residue("text"), _nl=L.non_latin_count("text"))
    return u.select("kind", "id", "turn", L.script_language_first("text", "_res").alias("lang_first"),
                    L.script_language_dominant("text", "_res", "_nl").alias("lang_dominant"),
                    F.col("_nl").cast("bigint").alias("non_latin"))


# ------------------------------------------------------------------ B5 / C15 / E5

@register("term_relevance",
          f"SELECT doc_id, CAST(len({O.hits('text', DOC_TERMS)}) AS BIGINT) AS n_hits, "
          f"{O.relevant('text', DOC_TERMS, DOC_IRRELEVANT, DOC_CONTEXT)} AS relevant, "
          f"{O.relevance_reason('text', DOC_TERMS, DOC_IRRELEVANT, DOC_CONTEXT)} AS reason FROM documents", "B5/C15")
def term_relevance(spark, sf):
    d = docs(spark, sf)
    return d.select("doc_id",
                    F.size(R.term_hits("text", DOC_TERMS)).cast("bigint").alias("n_hits"),
                    R.is_relevant("text", DOC_TERMS, DOC_IRRELEVANT, DOC_CONTEXT).alias("relevant"),
                    R.relevance_reason("text", DOC_TERMS, DOC_IRRELEVANT, DOC_CONTEXT).alias("reason"))


@register("term_hits_default",
          f"SELECT doc_id, array_to_string({O.hits('text', ENGLISH_TERMS)}, '|') AS hits, "
          f"{O.relevant('text', ENGLISH_TERMS)} AS relevant FROM documents",
          "C15/B5")
def term_hits_default(spark, sf):
    d = docs(spark, sf)
    return d.select("doc_id", F.array_join(R.term_hits("text", ENGLISH_TERMS), "|").alias("hits"),
                    R.is_relevant("text", ENGLISH_TERMS).alias("relevant"))


# Per-language keyword lists (a parameter); 'es' has none and falls back to English.
LANG_TERMS = {"en": ["thing", "thble", "attion"], "fr": ["tion", "ment", "eur"], "de": ["ung", "sch", "ein"]}


def _lang_terms_sql() -> str:
    from quern.dims.languages import ENGLISH_TERMS
    terms = {"en": ENGLISH_TERMS, **LANG_TERMS}
    rows = ", ".join(f"({O.lit(k)}, {O.lst(v)})" for k, v in terms.items())
    return f"(SELECT * FROM (VALUES {rows}) AS t(lang, terms))"


@register("relevance_by_language",
          "WITH t AS " + _lang_terms_sql() + ", d AS (SELECT d.doc_id, d.text, coalesce(t.terms, "
          "(SELECT terms FROM t WHERE lang = 'en')) AS terms FROM documents d LEFT JOIN t ON d.lang = t.lang) "
          "SELECT doc_id, CAST(len(list_filter(terms, lambda x: contains(lower(text), lower(x)))) AS BIGINT) AS n_hits FROM d",
          "E5")
def relevance_by_language(spark, sf):
    from quern.dims.languages import terms_frame
    d = docs(spark, sf)
    tf = terms_frame(spark, LANG_TERMS)
    return J.relevance_by_language(d, tf, "lang").select(
        "doc_id", F.size(R.term_hits("text", F.col("terms"))).cast("bigint").alias("n_hits"))


# Lists whose terms overlap, repeat and hold one another, beside the builtin ones.
OVERLAPPING = {"en": ["thing", "hin", "thin", "the", "ing", "the", "of the"], "fr": ["tion", "ion", "ment", "É"], "de": ["ung", "un", "sch", "ch"]}


def _all_lists() -> dict[str, list[str]]:
    from quern.dims.languages import REGIONAL_TERMS
    return {"en": ENGLISH_TERMS, **REGIONAL_TERMS, **OVERLAPPING}


def _all_lists_sql() -> str:
    rows = ", ".join(f"({O.lit(k)}, {O.lst(v)})" for k, v in _all_lists().items())
    found = lambda phrases: f"len(list_filter({phrases}, lambda p: contains(low, lower(p))))"
    return f"""WITH t AS (SELECT * FROM (VALUES {rows}) AS t(lang, terms)),
      d AS (SELECT doc_id, text, lower(coalesce(text, '')) AS low, coalesce(t.terms, (SELECT terms FROM t WHERE lang = 'en')) AS terms
            FROM documents d LEFT JOIN t ON d.lang = t.lang),
      h AS (SELECT doc_id, text, list_filter(terms, lambda x: contains(low, lower(x))) AS hits,
                   {found(O.lst(DOC_IRRELEVANT))} AS bad, {found(O.lst(DOC_CONTEXT))} AS good FROM d),
      r AS (SELECT doc_id, array_to_string(hits, '|') AS hits, CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN len(hits) = 0 THEN 'none'
                   WHEN bad > 2 THEN 'irrelevant' WHEN len(hits) >= 2 THEN 'multi' WHEN good >= 1 THEN 'single_context'
                   ELSE 'single_no_context' END AS reason FROM h)
      SELECT doc_id, hits, reason, reason IN ('multi', 'single_context') AS relevant FROM r"""


@register("relevance_all_lists", _all_lists_sql(), "B5/C15/E5 (all lists, one reading)")
def relevance_all_lists(spark, sf):
    from quern.operators import patterns
    d = docs(spark, sf).select("doc_id", "lang", "text")
    x = patterns.relevance_by_list(d, _all_lists(), irrelevant=DOC_IRRELEVANT, context=DOC_CONTEXT)
    return x.select("doc_id", F.array_join("hits", "|").alias("hits"), "reason", "relevant")


# ------------------------------------------------------------------ filters B8 / B9

@register("min_text", "SELECT doc_id FROM documents WHERE length(text) > 200", "B8")
def min_text(spark, sf):
    return B.min_text(docs(spark, sf), "text", 200).select("doc_id")


@register("main_quality",
          f"SELECT doc_id, extraction_quality FROM (SELECT doc_id, {O.quality('text')} AS extraction_quality "
          "FROM documents) WHERE extraction_quality IN ('high', 'medium')", "B9")
def main_quality(spark, sf):
    a = A.articles(spark, sf)
    return B.main_quality(a).select("doc_id", "extraction_quality")


# ------------------------------------------------------------------ stats F1–F7, H1, H2, H5

def _final_sql(select: str) -> str:
    """``select`` runs over ``f`` = the articles surviving smart dedup."""
    return (f"WITH {O.articles_cte()},\n{O.dedup_keys_cte()},\n{O.smart_dedup_ctes('best')},\n"
            f"f AS (SELECT a.* FROM articles a WHERE a.seq IN (SELECT seq FROM s3))\n{select}")


def _final(spark, sf):
    return D.smart_dedup(A.articles(spark, sf), "best",
                         ["doc_id", "title", "extraction_quality", "state", "article_language", "disaster_type"])


@register("duplicate_titles",
          f"WITH {O.articles_cte()} SELECT title, count(*) AS n FROM articles WHERE title IS NOT NULL AND title <> '' "
          "GROUP BY title HAVING count(*) > 1", "F1")
def duplicate_titles(spark, sf):
    return G.duplicate_groups(A.articles(spark, sf), "title")


@register("duplicate_urls",
          f"WITH {O.articles_cte()} SELECT normalized_url, count(*) AS n FROM articles "
          "WHERE normalized_url IS NOT NULL AND normalized_url <> '' GROUP BY normalized_url HAVING count(*) > 1", "F1")
def duplicate_urls(spark, sf):
    return G.duplicate_groups(A.articles(spark, sf), "normalized_url")


def _dist_sql(col: str) -> str:
    return _final_sql(f"SELECT coalesce({col}, 'unknown') AS {col}, count(*) AS count, "
                      f"round_even(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM f) * 100, 2) AS percentage "
                      f"FROM f GROUP BY 1")


@register("language_distribution", _dist_sql("article_language"), "F2")
def language_distribution(spark, sf):
    return G.distribution(_final(spark, sf), "article_language")


@register("quality_breakdown", _final_sql(
    "SELECT count(*) AS total, count(*) FILTER (WHERE extraction_quality = 'high') AS high, "
    "count(*) FILTER (WHERE extraction_quality = 'medium') AS medium, "
    "count(*) FILTER (WHERE extraction_quality = 'low') AS low, "
    "round_even(CAST(count(*) FILTER (WHERE extraction_quality = 'high') AS DOUBLE) / count(*) * 100, 2) AS high_pct, "
    "round_even(CAST(count(*) FILTER (WHERE extraction_quality = 'medium') AS DOUBLE) / count(*) * 100, 2) AS medium_pct, "
    "round_even(CAST(count(*) FILTER (WHERE extraction_quality = 'low') AS DOUBLE) / count(*) * 100, 2) AS low_pct FROM f"),
    "F3")
def quality_breakdown(spark, sf):
    return G.quality_breakdown(_final(spark, sf))


@register("region_breakdown", _dist_sql("state"), "F4")
def region_breakdown(spark, sf):
    return G.distribution(_final(spark, sf), "state")


@register("disaster_breakdown", _dist_sql("disaster_type"), "F5")
def disaster_breakdown(spark, sf):
    return G.distribution(_final(spark, sf), "disaster_type")


@register("run_stats", _final_sql(
    "SELECT (SELECT count(*) FROM f) AS total_articles, "
    "(SELECT count(*) FILTER (WHERE extraction_quality = 'high') FROM f) AS high, "
    "(SELECT count(*) FILTER (WHERE extraction_quality = 'medium') FROM f) AS medium, "
    "(SELECT count(*) FILTER (WHERE extraction_quality = 'low') FROM f) AS low, "
    "(SELECT string_agg(k || '=' || CAST(n AS VARCHAR) || '/' || CAST(round_even(CAST(n AS DOUBLE) / t * 100, 2) AS VARCHAR), ',' ORDER BY k) "
    " FROM (SELECT coalesce(article_language, 'unknown') AS k, count(*) AS n, (SELECT count(*) FROM f) AS t FROM f GROUP BY 1)) AS languages, "
    "(SELECT string_agg(k || '=' || CAST(n AS VARCHAR), ',' ORDER BY k) FROM (SELECT state AS k, count(*) AS n FROM f GROUP BY 1)) AS regions, "
    "(SELECT string_agg(k || '=' || CAST(n AS VARCHAR), ',' ORDER BY k) FROM (SELECT disaster_type AS k, count(*) AS n FROM f GROUP BY 1)) AS disasters"),
    "F6")
def run_stats(spark, sf):
    s = G.run_stats(_final(spark, sf), extraction_date="2026-08-08", extraction_timestamp="2026-08-08 00:00:00")
    return G.flatten_run_stats(s)


@register("extraction_counters",
          f"WITH {O.articles_cte()} SELECT state, disaster_type, count(*) AS articles_before_dedup, "
          "count(DISTINCT final_url) AS links FROM articles GROUP BY state, disaster_type", "F7")
def extraction_counters(spark, sf):
    return G.extraction_counters(A.articles(spark, sf))


@register("top_languages", _final_sql(
    "SELECT coalesce(article_language, 'unknown') AS article_language, count(*) AS count FROM f "
    "GROUP BY 1 ORDER BY count DESC, article_language LIMIT 3"), "H1")
def top_languages(spark, sf):
    return G.top_values(_final(spark, sf), "article_language", 3)


@register("regions_ranked", _final_sql("SELECT state, count(*) AS count FROM f GROUP BY state"), "H2")
def regions_ranked(spark, sf):
    return G.ranked(_final(spark, sf), "state")


@register("union_entries",
          "SELECT 0 AS part, doc_id AS seq, 'feed' AS kind, doc_id FROM documents WHERE lang = 'en' "
          "UNION ALL SELECT 1, doc_id, 'newspaper', doc_id FROM documents WHERE lang <> 'en'", "H5")
def union_entries(spark, sf):
    d = A.table(spark, sf, "documents").select("doc_id", "lang")
    feed = d.where(F.col("lang") == "en").select(F.col("doc_id").alias("seq"), F.lit("feed").alias("kind"), "doc_id")
    news = d.where(F.col("lang") != "en").select(F.col("doc_id").alias("seq"), F.lit("newspaper").alias("kind"), "doc_id")
    return J.union_entries(feed, news)
