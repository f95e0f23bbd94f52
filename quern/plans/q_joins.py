"""Join queries: E1 linkage, E2 enrichment, E3 region→language→terms,
E4 source directory, E8 saved searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.dims import languages as dims
from quern.functions import lang as L
from quern.operators import joins as J
from quern.plans import adapters as A
from quern.plans import oracle as O
from quern.plans.catalog import register

N_CSV = 8


# ------------------------------------------------------------------ linkage adapters (pages)

def links(spark, sf):
    """pages as CSV link rows: 8 'files'; every 10th link repeated later with a new title."""
    p = A.table(spark, sf, "pages").select("page_id", "url")
    base = p.select((F.col("page_id") % N_CSV).alias("csv"), (F.col("page_id") * 2).alias("seq"), F.col("url").alias("Link"),
                    F.concat(F.lit("t"), F.col("page_id").cast("string")).alias("Title"))
    dup = p.where(F.col("page_id") % 10 == 0).select(
        (F.col("page_id") % N_CSV).alias("csv"), (F.col("page_id") * 2 + 1).alias("seq"), F.col("url").alias("Link"),
        F.concat(F.lit("again"), F.col("page_id").cast("string")).alias("Title"))
    rows = base.unionByName(dup)
    return rows.select("*", F.concat(F.lit("src"), (F.col("seq") % 5).cast("string")).alias("Source"),
                       F.lit("").alias("Summary"), F.lit("2024-01-01 10:00:00").alias("Date"),
                       F.lit("Monsoon").alias("Term"), F.lit("en").alias("LanguageQueried"))


def finals(spark, sf):
    """Extracted final URLs: same, Google redirect, mobile host, changed path, truncated."""
    p = A.table(spark, sf, "pages").select("page_id", "url")
    k = F.col("page_id") % 5
    u = F.col("url")
    final = (F.when(k == 0, u)
             .when(k == 1, F.concat(F.lit("https://news.google.com/rss/articles/X"), F.col("page_id").cast("string")))
             .when(k == 2, F.regexp_replace(u, "^(https?://)(?:www\\.)?", "$1m."))
             .when(k == 3, F.regexp_replace(u, "/[0-9]+", "/999"))
             .otherwise(F.substring(u, 1, 12)))
    return p.select((F.col("page_id") % N_CSV).alias("csv"), F.col("page_id").alias("seq"),
                    u.alias("original_url"), final.alias("final_url"))


LINKS_SQL = f"""(SELECT page_id % {N_CSV} AS csv, page_id * 2 AS seq, url AS "Link", 't' || CAST(page_id AS VARCHAR) AS "Title" FROM pages
  UNION ALL SELECT page_id % {N_CSV}, page_id * 2 + 1, url, 'again' || CAST(page_id AS VARCHAR) FROM pages WHERE page_id % 10 = 0)"""
FINALS_SQL = f"""(SELECT page_id % {N_CSV} AS csv, page_id AS seq, url AS original_url, CASE page_id % 5
   WHEN 0 THEN url WHEN 1 THEN 'https://news.google.com/rss/articles/X' || CAST(page_id AS VARCHAR)
   WHEN 2 THEN regexp_replace(url, '^(https?://)(?:www\\.)?', '\\1m.')
   WHEN 3 THEN regexp_replace(url, '/[0-9]+', '/999', 'g') ELSE substring(url, 1, 12) END AS final_url FROM pages)"""


def _linkage_sql() -> str:
    dom_c, dom_f = O.domain("cand"), O.domain("final_url")
    sim = O.path_similarity("final_url", "cand")
    return f"""WITH f AS {FINALS_SQL}, c0 AS (SELECT csv, "Link" AS cand, min(seq) AS ord FROM {LINKS_SQL} GROUP BY 1, 2),
pairs AS (SELECT f.seq, f.csv, f.final_url, f.original_url, c.cand, c.ord FROM f JOIN c0 c ON f.csv = c.csv
          UNION ALL SELECT seq, csv, final_url, original_url, original_url, -1 FROM f),
s AS (SELECT *, {dom_c} = {dom_f} AS same_dom, {O.main_domain(dom_c)} = {O.main_domain(dom_f)} AS same_main,
             {sim} AS sim FROM pairs),
t AS (SELECT seq, csv, original_url, final_url,
   arg_min(cand, ord) FILTER (WHERE cand = final_url) AS t1,
   CASE WHEN contains(final_url, 'news.google.com') THEN arg_min(cand, ord) FILTER (WHERE contains(cand, 'news.google.com')) END AS t2,
   arg_min(cand, {{'s': CASE WHEN sim > 0 THEN -sim ELSE 0 END, 'o': ord}}) FILTER (WHERE same_dom) AS t3,
   arg_min(cand, ord) FILTER (WHERE same_main) AS t4,
   arg_min(cand, ord) FILTER (WHERE starts_with(final_url, cand) OR starts_with(cand, final_url)) AS t5
   FROM s GROUP BY seq, csv, original_url, final_url)
SELECT csv, seq, original_url, final_url, coalesce(t1, t2, t3, t4, t5, original_url) AS matched_link,
  CASE WHEN t1 IS NOT NULL THEN 1 WHEN t2 IS NOT NULL THEN 2 WHEN t3 IS NOT NULL THEN 3 WHEN t4 IS NOT NULL THEN 4
       WHEN t5 IS NOT NULL THEN 5 ELSE 0 END AS match_tier FROM t"""


LINKAGE_SQL = _linkage_sql()


@register("link_final_to_original", LINKAGE_SQL, "E1/C16")
def link_final_to_original(spark, sf):
    return J.link_final_to_original(finals(spark, sf), links(spark, sf), "csv")


@register("enrich_metadata",
          f"""WITH m AS ({LINKAGE_SQL}), l AS {LINKS_SQL},
              last AS (SELECT csv, "Link" AS matched_link, arg_max("Title", seq) AS csv_title FROM l GROUP BY 1, 2)
              SELECT m.seq, m.matched_link, coalesce(last.csv_title, '') AS csv_title
              FROM m LEFT JOIN last ON m.csv = last.csv AND m.matched_link = last.matched_link""", "E2")
def enrich_metadata(spark, sf):
    lk = links(spark, sf)
    m = J.link_final_to_original(finals(spark, sf), lk, "csv")
    e = J.enrich_metadata(m, lk, "csv")
    return e.select("seq", "matched_link", F.col("other_info.csv_title").alias("csv_title"))


@register("build_articles",
          f"""WITH m AS ({LINKAGE_SQL}), l AS {LINKS_SQL},
              last AS (SELECT csv, "Link" AS matched_link, arg_max("Title", seq) AS csv_title FROM l GROUP BY 1, 2),
              x AS (SELECT m.csv, m.seq, m.final_url, m.matched_link AS original_url, {O.normalize_url('m.final_url')} AS normalized_url,
                      CASE WHEN p.page_id % 2 = 0 THEN 'own ' || CAST(p.page_id AS VARCHAR) ELSE '' END AS page_title,
                      coalesce(last.csv_title, '') AS csv_title, p.html
                    FROM m JOIN pages p ON p.page_id = m.seq
                    LEFT JOIN last ON m.csv = last.csv AND m.matched_link = last.matched_link)
              SELECT csv, seq, md5(normalized_url || page_title) AS id,
                     CASE WHEN csv_title <> '' THEN csv_title ELSE page_title END AS title, csv_title, final_url, original_url,
                     normalized_url, {O.lang_dominant('html')} AS article_language, {O.quality('html')} AS extraction_quality
              FROM x""", "article assembly/E1/E2/C14")
def build_articles(spark, sf):
    text = A.table(spark, sf, "pages").select(
        F.col("page_id").alias("seq"), F.col("html").alias("article_text"), F.lit("assam").alias("state"),
        F.lit(A.DISASTER).alias("disaster_type"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("own "), F.col("page_id").cast("string"))).otherwise("").alias("page_title"))
    fields = finals(spark, sf).join(text, "seq")
    out = J.build_articles(fields, links(spark, sf), "2026-08-08 05:00:00")
    return out.select("csv", "seq", "id", "title", F.col("other_info.csv_title").alias("csv_title"), "final_url", "original_url",
                      "normalized_url", "article_language", "extraction_quality")


# ------------------------------------------------------------------ E3 / E8 (nations mapped onto regions)

ALL_REGIONS = dims.STATES + dims.UNION_TERRITORIES
# keyword lists per language (a parameter; other codes fall back to English)
REGION_TERMS = {"hi": ["the", "and", "of"], "ta": ["thing", "ing"], "bn": ["ation"], "te": ["er", "th", "an", "in",
                "on", "at", "es", "ed", "nd", "to"]}


def nation_regions(spark, sf):
    n = A.table(spark, sf, "nation").select("n_nationkey")
    arr = F.array(*[F.lit(r) for r in ALL_REGIONS])
    return n.select("n_nationkey", F.try_element_at(arr, (F.col("n_nationkey") % len(ALL_REGIONS)).cast("int") + 1)
                    .alias("region"))


def _regions_sql() -> str:
    arr = O.lst(ALL_REGIONS)
    return f"(SELECT n_nationkey, {arr}[CAST(n_nationkey % {len(ALL_REGIONS)} AS INTEGER) + 1] AS region FROM nation)"


def _dims_sql() -> str:
    rl = ", ".join(f"({O.lit(r)}, {i}, {O.lit(lang)})" for r, ls in dims.REGION_LANGUAGES.items()
                   for i, lang in enumerate(ls))
    terms = {"en": dims.ENGLISH_TERMS, **dims.REGIONAL_TERMS, **REGION_TERMS}
    tl = ", ".join(f"({O.lit(lang)}, {O.lst(ts)})" for lang, ts in terms.items())
    return (f"rl AS (SELECT * FROM (VALUES {rl}) t(region, lang_ord, lang)), "
            f"tl AS (SELECT * FROM (VALUES {tl}) t(lang, terms)), "
            f"r AS {_regions_sql()}, "
            f"x AS (SELECT r.n_nationkey, r.region, coalesce(rl.lang_ord, 0) AS lang_ord, coalesce(rl.lang, 'en') AS lang "
            f"FROM r LEFT JOIN rl ON r.region = rl.region), "
            f"y AS (SELECT x.*, coalesce(tl.terms, (SELECT terms FROM tl WHERE lang = 'en')) AS terms "
            f"FROM x LEFT JOIN tl ON x.lang = tl.lang)")


@register("region_language_terms",
          f"WITH {_dims_sql()} SELECT n_nationkey, region, lang_ord, lang, "
          f"CAST(generate_subscripts(terms, 1) - 1 AS INTEGER) AS term_ord, unnest(terms) AS term FROM y", "E3/C18")
def region_language_terms(spark, sf):
    r = nation_regions(spark, sf)
    out = J.region_language_terms(r, dims.terms_frame(spark, REGION_TERMS), "region")
    return r.join(out, "region").select("n_nationkey", "region", F.col("lang_ord").cast("int"), "lang",
                                        F.col("term_ord").cast("int"), "term")


def _searches_sql(select: str, full: bool = False) -> str:
    """SQL form of the saved-search table over y, small (three searches) or full."""
    more = """
         || (CASE WHEN n >= 10 THEN [{'query': '(' || terms[9] || ' OR ' || terms[10] || ') ' || region, 'phrases': [terms[9], terms[10]]}] ELSE [] END)
         || (CASE WHEN n >= 8 THEN [{'query': '(' || terms[1] || ' OR ' || terms[4] || ' OR ' || terms[8] || ') ' || region,
                                    'phrases': [terms[1], terms[4], terms[8]]}] ELSE [] END)""" if full else ""
    cut = "" if full else "[1:3]"
    q = f"""s0 AS (
  SELECT region, lang, terms, len(terms) AS n FROM y),
s1 AS (
  SELECT region, lang, list_transform(list_filter(terms[1:3], lambda t: {O.strip('t')} <> ''),
           lambda t: {{'query': '"' || t || '" ' || region, 'phrases': [t]}})
         || (CASE WHEN n >= 3 THEN [{{'query': '(' || terms[1] || ' OR ' || terms[2] || ') ' || region, 'phrases': [terms[1], terms[2]]}}] ELSE [] END)
         || (CASE WHEN n >= 6 THEN [{{'query': '(' || terms[4] || ' OR ' || terms[5] || ') ' || region, 'phrases': [terms[4], terms[5]]}}] ELSE [] END){more} AS qs
  FROM s0),
s2 AS (SELECT region, lang, CAST(generate_subscripts(qs{cut}, 1) - 1 AS INTEGER) AS query_ord, unnest(qs{cut}) AS s FROM s1),
srch AS (SELECT region, lang, query_ord, s.query AS query, s.phrases AS phrases FROM s2
         WHERE length(s.query) - length(replace(s.query, 'OR', '')) <= 8 AND length(s.query) <= 200)"""
    return f"WITH {_dims_sql()}, {q} {select}"


@register("saved_searches",
          _searches_sql("SELECT DISTINCT region, lang, query_ord, query FROM srch"), "E8/B13")
def saved_searches(spark, sf):
    r = nation_regions(spark, sf)
    rt = J.region_language_terms(r, dims.terms_frame(spark, REGION_TERMS), "region")
    arrays = (rt.groupBy("region", "lang_ord", "lang")
              .agg(F.array_sort(F.collect_list(F.struct("term_ord", "term"))).alias("t"))
              .select("region", "lang", F.transform("t", lambda s: s["term"]).alias("terms")))
    return J.saved_searches(arrays).select("region", "lang", F.col("query_ord").cast("int"), "query").distinct()


@register("saved_searches_full",
          _searches_sql("SELECT DISTINCT region, lang, query_ord, query FROM srch", full=True), "E8/B13 (full mode)")
def saved_searches_full(spark, sf):
    r = nation_regions(spark, sf)
    rt = J.region_language_terms(r, dims.terms_frame(spark, REGION_TERMS), "region")
    arrays = (rt.groupBy("region", "lang_ord", "lang")
              .agg(F.array_sort(F.collect_list(F.struct("term_ord", "term"))).alias("t"))
              .select("region", "lang", F.transform("t", lambda s: s["term"]).alias("terms")))
    return J.saved_searches(arrays, ci=True).select("region", "lang", F.col("query_ord").cast("int"), "query").distinct()


# E8 match: documents play the regions through their source column.
DOC_TERMS = {"en": ["thing", "thble", "attion", "ing", "the", "of"], "fr": ["tion", "ment"], "de": ["ung", "sch", "ein"]}


def _doc_searches_sql() -> str:
    terms = {"en": dims.ENGLISH_TERMS, **dims.REGIONAL_TERMS, **DOC_TERMS}
    tl = ", ".join(f"({O.lit(lang)}, {O.lst(ts)})" for lang, ts in terms.items())
    return (f"tl AS (SELECT * FROM (VALUES {tl}) t(lang, terms)), "
            f"y AS (SELECT DISTINCT d.source AS region, d.lang, coalesce(tl.terms, (SELECT terms FROM tl WHERE lang = 'en')) AS terms "
            f"FROM documents d LEFT JOIN tl ON d.lang = tl.lang)")


def _doc_match_sql() -> str:
    base = _searches_sql("")
    base = base.replace(f"WITH {_dims_sql()}, ", f"WITH {_doc_searches_sql()}, ")
    return (base + "SELECT d.doc_id, srch.query_ord, srch.query FROM documents d JOIN srch "
            "ON d.source = srch.region AND d.lang = srch.lang "
            "WHERE len(list_filter(srch.phrases, lambda p: contains(lower(d.text), lower(p)))) > 0")


@register("saved_search_match", _doc_match_sql(), "E8")
def saved_search_match(spark, sf):
    d = A.table(spark, sf, "documents").select("doc_id", F.col("source").alias("region"), "lang", "text")
    tf = dims.terms_frame(spark, DOC_TERMS)
    per = J.relevance_by_language(d.select("region", "lang").distinct(), tf, "lang")
    s = J.saved_searches(per)
    m = J.saved_search_match(d, s)
    return m.select("doc_id", F.col("query_ord").cast("int"), "query")


@register("saved_search_mention",
          _doc_match_sql() + " AND contains(lower(d.text), lower(substring(d.lang, 1, 1) || 'n'))", "E8 (region in the text)")
def saved_search_mention(spark, sf):
    """As ``saved_search_match``, and the region's words (here two letters by language) stand in the text."""
    d = A.table(spark, sf, "documents").select("doc_id", F.col("source").alias("region"), "lang", "text",
                                               F.concat(F.substring("lang", 1, 1), F.lit("n")).alias("region_words"))
    per = J.relevance_by_language(d.select("region", "lang").distinct(), dims.terms_frame(spark, DOC_TERMS), "lang")
    m = J.saved_search_match(d, J.saved_searches(per), mention="region_words")
    return m.select("doc_id", F.col("query_ord").cast("int"), "query")


# ------------------------------------------------------------------ E4 (suppliers as the newspaper directory)

def directory(spark, sf):
    s = A.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = A.table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    langs = F.array(*[F.lit(x) for x in ["English", "Hindi", "Tamil, English", "Bengali"]])
    return s.join(n, "s_nationkey").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 10 == 0, F.lit("National")).otherwise(F.col("n_name")).alias("State/UT"),
        F.col("s_name").alias("Newspaper Name"),
        F.concat(F.lit("https://"), F.lower(F.regexp_replace("s_name", "[^A-Za-z0-9]", "")), F.lit(".example.in")).alias("Website"),
        F.try_element_at(langs, (F.col("s_suppkey") % 4).cast("int") + 1).alias("Language(s)"))


def _title_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ')")


@register("sources_for_region",
          f"""WITH d AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN 'National' ELSE n_name END AS st,
                   CASE s_suppkey % 4 WHEN 0 THEN 'English' WHEN 1 THEN 'Hindi' WHEN 2 THEN 'Tamil, English' ELSE 'Bengali' END AS langs
                   FROM supplier JOIN nation ON s_nationkey = n_nationkey),
              r AS (SELECT lower(replace(n_name, ' ', '-')) AS region FROM nation),
              st AS (SELECT region, {_title_sql("replace(region, '-', ' ')")} AS disp FROM r),
              pats AS (SELECT region, 0 AS prio, disp AS pattern FROM st
                       UNION ALL SELECT region, 1, replace(disp, 'And', '&') FROM st
                       UNION ALL SELECT region, 2, CASE WHEN position(' ' IN disp) > 0 THEN split_part(disp, ' ', 1) ELSE disp END FROM st),
              m AS (SELECT region, prio, s_suppkey, langs FROM d JOIN pats ON contains(lower(d.st), lower(pats.pattern))),
              b AS (SELECT region, min(prio) AS prio FROM m GROUP BY region)
              SELECT m.region, m.prio, m.s_suppkey,
                {'(CASE ' + ' '.join(f"WHEN contains(lower(m.langs), '{k}') THEN '{v}'" for k, v in dims.NEWSPAPER_LANGUAGE) + " ELSE 'en' END)"} AS lang_code
              FROM m JOIN b USING (region, prio)""", "E4/C17/C19")
def sources_for_region(spark, sf):
    d = directory(spark, sf)
    regions = A.table(spark, sf, "nation").select(F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))).alias("region"))
    strat = J.source_strategies(spark, regions)
    out = J.sources_for_region(d, strat)
    return out.select("region", "prio", "s_suppkey", L.language_code(F.col("`Language(s)`")).alias("lang_code"))


@register("national_sources",
          "SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 = 0", "E4")
def national_sources(spark, sf):
    return J.national_sources(directory(spark, sf)).select("s_suppkey")
