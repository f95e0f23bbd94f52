"""Row filters and predicates (B1–B14) as DataFrame operators.

All are narrow transformations (no shuffle) except B4, whose per-group
cap needs each problematic row's rank inside its group; that rank comes
from ``rank_in_group`` which never puts a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import dates as Dt
from quern.functions import relevance as R
from quern.functions import url as U
from quern.functions.text import _c, clip
from quern.operators.common import materialize
from quern.operators.ranking import rank_in_group


def valid_links(df: DataFrame, url: str = "Link") -> DataFrame:
    """B1 — keep rows whose trimmed link starts with http(s)://; link trimmed."""
    from quern.functions.text import py_strip
    return df.where(U.valid_link(url)).withColumn(url, py_strip(F.col(url)))


def link_reject_counts(df: DataFrame, url: str = "Link") -> DataFrame:
    """B1 counters: total and rejected links."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(~U.valid_link(url)).alias("rejected"))


def cap_problematic(df: DataFrame, group: str, url: str, ratio: float = 0.2,
                    seq: str = "seq") -> DataFrame:
    """B4 — per group keep every clean row plus the first ``int(n·ratio)``
    problematic rows in input order (n = rows in the group).

    Adds ``is_problematic``; "clean first" output order is a sort on
    ``(group, is_problematic, seq)`` the caller may apply.
    """
    flagged = df.withColumn("is_problematic", U.is_problematic_url(url))
    sizes = flagged.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    probs = rank_in_group(flagged.where("is_problematic").select(group, seq), group, seq, "_r")
    keep = (probs.join(sizes, group)
            .where(F.col("_r") < F.floor(F.col("_n") * F.lit(ratio)))
            .select(seq))
    return (flagged.where(~F.col("is_problematic"))
            .unionByName(flagged.where("is_problematic").join(keep, seq, "left_semi")))


def min_text(df: DataFrame, text: str = "article_text", n: int = 200) -> DataFrame:
    """B8 — keep extractions longer than ``n`` characters."""
    return df.where(F.length(F.col(text)) > n)


def main_quality(df: DataFrame, col: str = "extraction_quality") -> DataFrame:
    """B9 — high ∪ medium."""
    return df.where(F.col(col).isin("high", "medium"))


def region_selection(df: DataFrame, region: str | None, region_col: str = "region") -> DataFrame:
    """B10 — one region, or all when ``region`` is None.  An unknown name
    raises with the valid list (a parameter check on the driver)."""
    from quern.dims.languages import STATES, UNION_TERRITORIES
    if region is None:
        return df
    if region not in STATES + UNION_TERRITORIES:
        raise ValueError(f"invalid state/UT {region!r}; states: {', '.join(STATES)}; "
                         f"UTs: {', '.join(UNION_TERRITORIES)}")
    return df.where(F.col(region_col) == region)


def strict_date_filter(df: DataFrame, start: str, end: str, published: str = "published",
                       link: str = "link") -> DataFrame:
    """B6 — resolve each entry's IST date; keep it when inside [start, end],
    else rescue it with a URL date inside the range (time 12:00:00), else drop.

    Adds ``ist_date`` (the string written out), ``article_date`` and
    ``date_status`` (in_range / url_rescued / parse_error_rescued / out_of_range /
    parse_error).
    """
    # Each derived value is its own projection and referenced by name, so
    # the large regex expressions are evaluated once per row, not re-inlined.
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    x = materialize(df, _ist=Dt.gmt_to_ist(F.col(published)), _url_d=Dt.date_from_url(F.col(link)))
    x = materialize(x, _ts=Dt.parse_ist(F.col("_ist")))
    ts, url_d = F.col("_ts"), F.col("_url_d")
    url_ok = F.coalesce(url_d.between(s, e), F.lit(False))
    status = (F.when(ts.isNotNull() & F.to_date(ts).between(s, e), F.lit("in_range"))
              .when(ts.isNotNull() & url_ok, F.lit("url_rescued"))
              .when(ts.isNotNull(), F.lit("out_of_range"))
              .when(url_ok, F.lit("parse_error_rescued"))
              .otherwise(F.lit("parse_error")))
    x = materialize(x, date_status=status)
    inr, resc = F.col("date_status") == "in_range", F.col("date_status").endswith("rescued")
    noon = F.concat(F.date_format(url_d, "yyyy-MM-dd"), F.lit(" 12:00:00"))
    return (x.withColumn("article_date", F.when(inr, F.to_date(ts)).when(resc, url_d))
            .withColumn("ist_date", F.when(inr, F.col("_ist")).when(resc, noon))
            .drop("_ist", "_url_d", "_ts"))


def collect_entries(df: DataFrame, terms, start: str, end: str, term: str, lang: str,
                    title: str = "title", summary: str = "summary", keep_status: bool = False,
                    irrelevant=R.IRRELEVANT, context=R.CONTEXT) -> DataFrame:
    """B7 — title relevant → B6 date → (title + ' ' + summary) relevant → 7 columns."""
    t = df.where(R.is_relevant(F.col(title), terms, irrelevant, context))
    t = strict_date_filter(t, start, end).where(F.col("article_date").isNotNull())
    combined = F.concat(F.col(title), F.lit(" "), F.coalesce(F.col(summary), F.lit("")))
    t = t.where(R.is_relevant(combined, terms, irrelevant, context))
    cols = [F.col(title).alias("Title"), F.col("link").alias("Link"), F.col("ist_date").alias("Date"),
            F.coalesce(F.col("source_title"), F.lit("")).alias("Source") if "source_title" in df.columns
            else F.lit("").alias("Source"),
            F.coalesce(F.col(summary), F.lit("")).alias("Summary"),
            F.lit(term).alias("Term"), F.lit(lang).alias("LanguageQueried")]
    if keep_status:
        cols += [F.col("seq"), F.col("date_status")]
    return t.select(*cols)


def drop_bad_dates(df: DataFrame, date: str = "Date") -> DataFrame:
    """B12 — rows whose ``Date`` does not parse as a timestamp are removed."""
    return df.where(F.try_to_timestamp(F.col(date)).isNotNull())


def short_query_guard(df: DataFrame, query: str = "query") -> DataFrame:
    """B13 — keep saved searches with ≤ 4 'OR' and ≤ 200 characters."""
    q = F.col(query)
    return df.where((F.regexp_count(q, F.lit("OR")) <= 4) & (F.length(q) <= 200))


def coarse_lookback(df: DataFrame, ts: str, end: str, days_back: int) -> DataFrame:
    """B14 — cheap pre-filter: published within max(N+7, 7) days before ``end``.
    A plain range predicate on the column, so it reaches the parquet scan."""
    lo = F.date_sub(F.to_date(F.lit(end)), max(days_back + 7, 7))
    return df.where(F.col(ts) >= lo.cast("timestamp"))


def clip_summary(df: DataFrame, col: str = "summary", n: int = 300) -> DataFrame:
    return df.withColumn(col, clip(_c(col), n))
