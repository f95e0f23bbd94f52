"""Joins the reference computes in loops.

Design rules:
* every join is an equi-join on a key that spreads the data; dimension
  tables built from fixed literals or parameters are broadcast (their size
  is fixed by construction);
* the linkage cascade (E1) has a module of its own, ``linkage``;
* per-link "last row wins" (E2) is ``max(struct(seq, …))`` with map-side
  combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.dims import languages as dims
from quern.functions import lang as L
from quern.functions import quality as Q
from quern.functions import url as U
from quern.functions.text import py_strip
from quern.operators.common import materialize
from quern.operators.linkage import link_final_to_original


# ------------------------------------------------------------------ E5 / E3

def relevance_by_language(df: DataFrame, terms: DataFrame, lang: str = "lang") -> DataFrame:
    """E5 — attach the term list of each row's language; unknown → English.

    ``terms`` is the (lang, ord, term) parameter table; the planner decides
    by its size how to join it. The fallback is the English list of ``terms``
    itself, read as a scalar (one value for all rows, no join); the builtin
    list only where the table has no English.
    """
    arrays = (terms.groupBy("lang")
              .agg(F.array_sort(F.collect_list(F.struct("ord", "term"))).alias("_t"))
              .select(F.col("lang").alias("_lang"), F.transform("_t", lambda s: s["term"]).alias("terms")))
    english = arrays.where(F.col("_lang") == "en").agg(F.first("terms")).scalar()  # one row, null without English
    builtin = F.array(*[F.lit(t) for t in dims.ENGLISH_TERMS])
    return (df.join(arrays, F.col(lang) == F.col("_lang"), "left")
            .withColumn("terms", F.coalesce("terms", english, builtin)).drop("_lang"))


def region_language_terms(regions: DataFrame, terms: DataFrame, region: str = "region") -> DataFrame:
    """E3 — region → ordered languages → ordered terms (unknown language → English)."""
    from quern.functions.lang import region_languages
    rl = regions.select(F.col(region), F.posexplode(region_languages(F.col(region))).alias("lang_ord", "lang"))
    arrays = relevance_by_language(rl, terms, "lang")
    return arrays.select(region, "lang_ord", "lang", F.posexplode("terms").alias("term_ord", "term"))


# ------------------------------------------------------------------ H5

def union_entries(*parts: DataFrame, part: str = "part") -> DataFrame:
    """H5 — bag concatenation; rows keep their own ``seq`` and get the number
    of their ``part``, so input order is (part, seq) whatever the ids are."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn(part, F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out


# ------------------------------------------------------------------ E4

def source_strategies(spark: SparkSession, regions: DataFrame, region: str = "region") -> DataFrame:
    """(region, prio, pattern): display name, '&' form, first word, aliases."""
    from quern.functions.lang import region_display
    disp = region_display(F.col(region))
    alias_map = F.create_map(*[x for r, al in dims.REGION_ALIASES.items()
                               for x in (F.lit(r), F.array(*[F.lit(a) for a in al]))])
    base = F.array(disp, F.replace(disp, F.lit("And"), F.lit("&")),
                   F.when(F.instr(disp, " ") > 0, F.substring_index(disp, " ", 1)).otherwise(disp))
    pats = F.concat(base, F.coalesce(F.try_element_at(alias_map, F.col(region)), F.array().cast("array<string>")))
    return regions.select(region, F.posexplode(pats).alias("prio", "pattern"))


def sources_for_region(directory: DataFrame, strategies: DataFrame, region: str = "region",
                       state_col: str = "State/UT") -> DataFrame:
    """E4 — per region, the directory rows matched by its first strategy that
    matches anything (case-insensitive ``contains``).

    ``contains`` is tried on the distinct state names only (as many as there
    are states); the directory itself is joined by equality.
    """
    states = directory.select(F.lower(F.col(f"`{state_col}`")).alias("_state")).distinct()
    names = states.join(strategies, F.instr(F.col("_state"), F.lower("pattern")) > 0)
    m = directory.withColumn("_state", F.lower(F.col(f"`{state_col}`"))).join(names, "_state").drop("_state")
    best = m.groupBy(region).agg(F.min("prio").alias("prio"))
    return m.join(best, [region, "prio"]).drop("pattern")


def national_sources(directory: DataFrame, state_col: str = "State/UT") -> DataFrame:
    return directory.where(F.instr(F.lower(F.col(f"`{state_col}`")), "national") > 0)


# ------------------------------------------------------------------ E9

def coverage_gaps(regions: DataFrame, counts: DataFrame, start: str, end: str,
                  region: str = "region", day: str = "day") -> DataFrame:
    """E9 — every (region, day) of [start, end] without a row in ``counts``.

    The spine is generated per region row (``explode(sequence)``), not by a
    cartesian product; regions are a dimension.
    """
    spine = regions.select(region, F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias(day))
    return spine.join(counts.select(region, day).distinct(), [region, day], "left_anti")


# ------------------------------------------------------------------ E8

def saved_searches(region_terms: DataFrame, region: str = "region", lang: str = "lang",
                   terms: str = "terms", ci: bool = False) -> DataFrame:
    """E8 — the saved searches per (region, lang) from its ordered term list.

    ``"t0" r``, ``"t1" r``, ``"t2" r``; ``(t0 OR t1) r``; ``(t3 OR t4) r``;
    in full mode also ``(t8 OR t9) r`` and ``(t0 OR t3 OR t7) r``; the small
    mode keeps the first three.  No terms → ``monsoon r``.  Each search
    carries its phrases; B13 drops searches with > 4 'OR' or > 200 chars.
    """
    t = F.col(terms)
    r = F.col(region)
    n = F.coalesce(F.size(t), F.lit(0))

    def q(phrases, text):
        return F.struct(text.alias("query"), phrases.alias("phrases"))

    def alt(*xs):
        arr = F.array(*xs)
        return q(arr, F.concat(F.lit("("), F.array_join(arr, " OR "), F.lit(") "), r))

    prio = F.transform(F.filter(F.slice(t, 1, 3), lambda x: py_strip(x) != ""),
                       lambda x: q(F.array(x), F.concat(F.lit('"'), x, F.lit('" '), r)))
    empty = F.array().cast("array<struct<query:string,phrases:array<string>>>")
    weather = F.when(n >= 3, F.array(alt(t[0], t[1])))
    impact = F.when(n >= 6, F.array(alt(t[3], t[4])))
    base = F.concat(prio, F.coalesce(weather, empty), F.coalesce(impact, empty))
    if ci:
        health = F.when(n >= 10, F.array(alt(t[8], t[9])))
        broad_terms = F.filter(F.array(t[0], t[3], t[7]), lambda x: x != "")
        broad = F.when(n >= 8, F.array(q(broad_terms, F.concat(F.lit("("), F.array_join(broad_terms, " OR "),
                                                              F.lit(") "), r))))
        qs = F.concat(base, F.coalesce(health, empty), F.coalesce(broad, empty))
    else:
        qs = F.slice(base, 1, 3)
    qs = F.when(n == 0, F.array(q(F.array(F.lit("monsoon")), F.concat(F.lit("monsoon "), r)))).otherwise(qs)
    out = region_terms.select(region, lang, F.posexplode(qs).alias("query_ord", "s"))
    out = out.select(region, lang, "query_ord", F.col("s.query").alias("query"), F.col("s.phrases").alias("phrases"))
    return out.where((F.regexp_count(F.col("query"), F.lit("OR")) <= 4) & (F.length("query") <= 200))


def saved_search_match(docs: DataFrame, searches: DataFrame, region: str = "region", lang: str = "lang",
                       text: str = "text", mention: str | None = None) -> DataFrame:
    """E8 — documents matched by the saved searches of their (region, language):
    an equi-join on (region, lang), then any phrase contained in lower(text)
    and, with ``mention`` (the column holding the region's words as the search
    has them), the region in the text as well."""
    j = materialize(docs, _low=F.lower(F.col(text))).join(searches, [region, lang])
    hit = F.exists("phrases", lambda p: F.instr(F.col("_low"), F.lower(p)) > 0)
    if mention:
        hit = hit & (F.instr(F.col("_low"), F.lower(F.col(mention))) > 0)
    return j.where(hit).drop("_low")


# ------------------------------------------------------------------ E1 / E2

def enrich_metadata(matched: DataFrame, links: DataFrame, group: str = "csv",
                    link_seq: str = "seq", extracted_title: str | None = None) -> DataFrame:
    """E2 — attach the CSV row of the matched link (a repeated Link: last row
    wins); no match → blanks.  Adds ``other_info`` and, where the column of the page's
    own title is named, ``title``: the row's title, else the page's."""
    cols = ["Title", "Source", "Summary", "Date", "Term", "LanguageQueried"]
    last = (links.select(F.col(group), py_strip(F.col("Link")).alias("matched_link"),
                         F.struct(F.col(link_seq).alias("_s"), *[F.col(c) for c in cols]).alias("r"))
            .groupBy(group, "matched_link").agg(F.max("r").alias("r")))
    j = matched.join(last, [group, "matched_link"], "left")
    info = F.struct(*[F.coalesce(F.col(f"r.{c}"), F.lit("")).alias(f"csv_{c.lower() if c != 'LanguageQueried' else 'language_queried'}")
                      for c in cols])
    out = j.withColumn("other_info", info).drop("r")
    if extracted_title is None:
        return out
    # the title of the link row, else the one found in the page
    return out.withColumn("title", F.when(F.col("other_info.csv_title") != "", F.col("other_info.csv_title"))
                          .otherwise(F.coalesce(F.col(extracted_title), F.lit(""))))


def build_articles(fields: DataFrame, links: DataFrame, extraction_timestamp: str, group: str = "csv", seq: str = "seq",
                   link_seq: str = "seq") -> DataFrame:
    """Extracted pages ⋈ the link rows of their CSV → Article rows (§1).

    ``fields``: (group, seq, original_url, final_url, page_title,
    article_text, state, disaster_type).  The page is matched to a link
    (E1), takes that link's row (E2), and its id is the md5 of the
    normalised final URL and the page's own title.
    """
    matched = link_final_to_original(fields, links, group, seq, link_seq)
    rows = enrich_metadata(matched, links, group, link_seq)
    own = fields.select(F.col(group), F.col(seq), "page_title", "article_text", "state", "disaster_type")
    j = rows.join(own, [group, seq])
    normalized = U.normalize_url(F.col("final_url"))
    return j.select(
        F.col(group), F.col(seq), U.article_id(normalized, F.col("page_title")).alias("id"),
        F.coalesce(F.nullif(F.col("other_info.csv_title"), F.lit("")), F.col("page_title"), F.lit("")).alias("title"),
        "final_url", F.col("matched_link").alias("original_url"), normalized.alias("normalized_url"), "article_text",
        L.script_language_dominant(F.coalesce("article_text", F.lit(""))).alias("article_language"), "other_info",
        "state", "disaster_type", F.lit(extraction_timestamp).alias("extraction_timestamp"),
        Q.quality_grade("article_text").alias("extraction_quality"))
