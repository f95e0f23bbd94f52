"""Aggregations (F1–F13) and the nested run statistics.

All are hash aggregates with Spark's partial (map-side) step; global
totals are one-row aggregates joined back by a broadcast of that single
row (its size is one row by construction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import _c


def pct(num, den, digits: int = 2) -> F.Column:
    """``round(num / den * 100, digits)`` with Python's half-even rounding."""
    return F.bround(_c(num).cast("double") / _c(den) * 100, digits)


#: The block of the run statistics that the dedup report reads.
DEDUPLICATION = ("struct<original_count:bigint,final_count:bigint,removal_percentage:double,url_duplicates_removed:bigint,"
                 "title_duplicates_removed:bigint,content_duplicates_removed:bigint>")


def dedup_funnel(chain: DataFrame) -> DataFrame:
    """F8 — original, final, removed per stage and removal % from the
    output of ``dedup_chain`` (its per-survivor counts), one pass."""
    c = chain.agg(
        F.sum("n_in").alias("original"),
        F.sum("n_url").alias("n_url"),
        F.sum("n_content").alias("n_content"),
        F.count(F.lit(1)).alias("final"),
    )
    return c.select(
        "original", "final",
        (F.col("original") - F.col("n_url")).alias("removed_url"),
        (F.col("n_url") - F.col("n_content")).alias("removed_content"),
        (F.col("n_content") - F.col("final")).alias("removed_title"),
        F.when(F.col("original") > 0, pct(F.col("original") - F.col("final"), "original"))
         .otherwise(F.lit(0.0)).alias("removal_pct"),
    )


def duplicate_groups(df: DataFrame, col: str) -> DataFrame:
    """F1 — non-empty values that occur more than once, with their count."""
    return (df.where(F.col(col).isNotNull() & (F.col(col) != ""))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def distribution(df: DataFrame, col: str, null_as: str = "unknown") -> DataFrame:
    """F2/F4/F5 — count and percentage of total per value (null → ``null_as``)."""
    v = df.select(F.coalesce(F.col(col), F.lit(null_as)).alias(col))
    g = v.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return with_total(g, g.agg(F.sum("count").alias("_total"))).select(
        col, "count", pct("count", "_total").alias("percentage"))


def with_total(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row.

    The right side is a global aggregate, i.e. exactly one row, so the
    broadcast is bounded by construction; the join is an equi-join on a
    constant key (no cartesian product in the plan).
    """
    return (df.withColumn("_one", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one"))


def quality_breakdown(df: DataFrame, col: str = "extraction_quality") -> DataFrame:
    """F3 — high / medium / low counts (zeros kept) and their percentages."""
    c = df.agg(F.count(F.lit(1)).alias("total"),
               *[F.count_if(F.col(col) == q).alias(q) for q in ("high", "medium", "low")])
    return c.select("total", "high", "medium", "low",
                    *[F.when(F.col("total") > 0, pct(q, "total")).otherwise(F.lit(0.0)).alias(f"{q}_pct")
                      for q in ("high", "medium", "low")])


def run_stats(df: DataFrame, extraction_date: str, extraction_timestamp: str,
              lang: str = "article_language", quality: str = "extraction_quality",
              region: str = "state", disaster: str = "disaster_type", funnel: DataFrame | None = None) -> DataFrame:
    """F6 — the nested one-row run statistics document.

    The articles are counted once by their four dimensions (combined in the
    map tasks); totals and maps are made from those few counts.  ``funnel``
    (the one row of :func:`dedup_funnel`) fills the ``deduplication`` block.
    """
    cells = df.groupBy(*[F.col(c).alias(d) for d, c in
                         (("lang", lang), ("region", region), ("disaster", disaster), ("quality", quality))]) \
        .agg(F.count(F.lit(1)).alias("n"))
    dims = F.array(*[F.struct(F.lit(d).alias("d"), F.coalesce(F.col(d), F.lit("unknown")).alias("k"))
                     for d in ("lang", "region", "disaster", "quality")])
    per = cells.select("n", F.explode(dims).alias("e")).groupBy("e.d", "e.k").agg(F.sum("n").alias("n"))
    # one entry per distinct value of a dimension column (regions, languages, hazards)
    m = per.agg(*[F.map_from_entries(F.collect_list(F.when(F.col("d") == d, F.struct("k", "n")))).alias(d)
                  for d in ("lang", "region", "disaster", "quality")],
                F.coalesce(F.sum(F.when(F.col("d") == "quality", F.col("n"))), F.lit(0)).alias("total"))
    grade = lambda q: F.coalesce(F.try_element_at("quality", F.lit(q)), F.lit(0)).cast("bigint").alias(q)
    dedup = F.lit(None).cast(DEDUPLICATION) if funnel is None else funnel.select(F.struct(
        F.col("original").alias("original_count"), F.col("final").alias("final_count"),
        F.col("removal_pct").alias("removal_percentage"), F.col("removed_url").alias("url_duplicates_removed"),
        F.col("removed_title").alias("title_duplicates_removed"),
        F.col("removed_content").alias("content_duplicates_removed")).cast(DEDUPLICATION)).scalar()
    return m.select(
        F.lit(extraction_date).alias("extraction_date"),
        F.col("total").alias("total_articles"),
        F.struct(F.col("total").alias("total_articles"),
                 F.transform_values("lang", lambda k, n: F.struct(n.alias("count"), pct(n, F.col("total")).alias("percentage")))
                 .alias("language_distribution")).alias("language_stats"),
        F.struct(grade("high"), grade("medium"), grade("low")).alias("quality_breakdown"),
        F.col("region").alias("region_breakdown"), F.col("disaster").alias("disaster_breakdown"),
        dedup.alias("deduplication"),
        F.lit(extraction_timestamp).alias("extraction_timestamp"),
    )


def flatten_run_stats(stats: DataFrame) -> DataFrame:
    """Sorted 'k=v' strings of the maps (for comparison and display)."""
    def flat(m, fmt):
        return F.array_join(F.transform(F.array_sort(F.map_entries(m)), fmt), ",")
    return stats.select(
        F.col("total_articles"),
        F.col("quality_breakdown.high").alias("high"),
        F.col("quality_breakdown.medium").alias("medium"),
        F.col("quality_breakdown.low").alias("low"),
        flat(F.col("language_stats.language_distribution"),
             lambda e: F.concat(e["key"], F.lit("="), e["value"]["count"].cast("string"), F.lit("/"),
                                e["value"]["percentage"].cast("string"))).alias("languages"),
        flat(F.col("region_breakdown"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))).alias("regions"),
        flat(F.col("disaster_breakdown"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))).alias("disasters"),
    )


def extraction_counters(df: DataFrame, region: str = "state", disaster: str = "disaster_type",
                        file_col: str = "final_url") -> DataFrame:
    """F7 — articles before dedup and distinct source files per region/hazard."""
    return df.groupBy(region, disaster).agg(F.count(F.lit(1)).alias("articles_before_dedup"),
                                            F.countDistinct(file_col).alias("links"))


def top_values(df: DataFrame, col: str, k: int, null_as: str = "unknown") -> DataFrame:
    """H1 — the k most frequent values (ties by value); a top-k report."""
    g = (df.select(F.coalesce(F.col(col), F.lit(null_as)).alias(col))
         .groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    return g.orderBy(F.desc("count"), F.asc(col)).limit(k)


def ranked(df: DataFrame, col: str) -> DataFrame:
    """H2 — every value with its count, ordered by count desc (a distributed sort)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


def url_filter_counts(urls: DataFrame, kept: DataFrame, url: str = "url") -> DataFrame:
    """F13 — invalid / clean / problematic links and rows kept by the cap."""
    from quern.functions.url import is_problematic_url, valid_link
    v, p = valid_link(url), is_problematic_url(url)
    c = urls.agg(F.count_if(~v).alias("invalid"), F.count_if(v & ~p).alias("clean"),
                 F.count_if(v & p).alias("problematic"))
    return with_total(c, kept.agg(F.count(F.lit(1)).alias("kept")))


def rejection_funnel(entries: DataFrame, terms, start: str, end: str, title: str = "title",
                     summary: str = "summary", irrelevant=None, context=None) -> DataFrame:
    """F9 — content-rejected, out-of-range and parse-error counts of B7.

    Parse errors are counted even when a URL date rescues the entry.
    """
    from quern.functions import relevance as R
    from quern.operators.filters import strict_date_filter
    irrelevant = R.IRRELEVANT if irrelevant is None else irrelevant
    context = R.CONTEXT if context is None else context
    d = strict_date_filter(entries, start, end)
    t_ok = R.is_relevant(F.col(title), terms, irrelevant, context)
    combined = F.concat(F.col(title), F.lit(" "), F.coalesce(F.col(summary), F.lit("")))
    c_ok = R.is_relevant(combined, terms, irrelevant, context)
    kept = F.col("article_date").isNotNull()
    st = F.col("date_status")
    return d.agg(
        (F.count_if(~t_ok) + F.count_if(t_ok & kept & ~c_ok)).alias("content_rejected"),
        F.count_if(t_ok & (st == "out_of_range")).alias("out_of_range"),
        F.count_if(t_ok & st.startswith("parse_error")).alias("parse_error"),
    )


def dates_present(df: DataFrame, date: str) -> DataFrame:
    """F11 — the sorted distinct dates as one string (bounded by the date window)."""
    return df.agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.col(date))),
                                           lambda d: F.date_format(d, "yyyy-MM-dd")), ",").alias("dates"))
