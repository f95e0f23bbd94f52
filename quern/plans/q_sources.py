"""Source/sink round trips (A1–A8) over data Spark derives from the tables.

Each query writes through the sink into a fresh folder under the shared
checkpoint directory and reads it back through the matching source.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from quern.dims import languages as dims
from quern.operators import aggs as G
from quern.operators import dedup as D
from quern.operators import filters as B
from quern.plans import adapters as A
from quern.plans.catalog import register
from quern.plans.q_dedup import FUNNEL_SQL
from quern.plans.q_dates import END, KEPT_SQL, LINKS_SQL, START
from quern.plans.q_text import _final_sql
from quern.session import checkpoint_dir, shared_table
from quern.sources import io

REGIONS = dims.STATES + dims.UNION_TERRITORIES


def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


@register("link_tree_roundtrip",
          f"""SELECT "Link", region, run_date FROM (SELECT link AS "Link", article_date AS run_date,
                {'[' + ', '.join(repr(r) for r in REGIONS) + ']'}[CAST(seq % {len(REGIONS)} AS INTEGER) + 1] AS region
              FROM {KEPT_SQL}) WHERE run_date BETWEEN DATE '2000-12-01' AND DATE '2000-12-31'""", "A2/A3")
def link_tree_roundtrip(spark, sf):
    d = B.strict_date_filter(A.dated_links(spark, sf), START, END).where(F.col("article_date").isNotNull())
    arr = F.array(*[F.lit(r) for r in REGIONS])
    region = F.try_element_at(arr, (F.col("seq") % len(REGIONS)).cast("int") + 1)
    rows = d.select(F.col("title").alias("Title"), F.col("link").alias("Link"), F.col("ist_date").alias("Date"),
                    F.lit("").alias("Source"), F.col("summary").alias("Summary"), F.lit("Monsoon").alias("Term"),
                    F.lit("en").alias("LanguageQueried"),
                    F.when(region.isin(*dims.STATES), "states").otherwise("union-territories").alias("region_type"),
                    region.alias("region"), F.lit("Monsoon").alias("disaster_type"),
                    F.col("article_date").alias("run_date"))
    root = _scratch(spark, "links")
    io.write_links(rows, root)
    back = io.links_for_dates(io.read_links_hive(spark, root), END, 30)
    return back.select("Link", "region", "run_date")


@register("link_tree_read",
          f"""SELECT link AS "Link", title AS "Title", summary AS "Summary", region, run_date FROM (SELECT link, title, summary, article_date AS run_date,
                {'[' + ', '.join(repr(r) for r in REGIONS) + ']'}[CAST(seq % {len(REGIONS)} AS INTEGER) + 1] AS region
              FROM {KEPT_SQL}) WHERE run_date BETWEEN DATE '2000-12-25' AND DATE '2000-12-31'""", "A1/A2")
def link_tree_read(spark, sf):
    """The region/day tree of ``results.csv`` files, laid out as the collector does, read back whole."""
    d = B.strict_date_filter(A.dated_links(spark, sf), START, END).where(F.col("article_date").between("2000-12-25", "2000-12-31"))
    arr = F.array(*[F.lit(r) for r in REGIONS])
    rows = d.select(F.col("title").alias("Title"), F.col("link").alias("Link"), F.col("summary").alias("Summary"),
                    F.try_element_at(arr, (F.col("seq") % len(REGIONS)).cast("int") + 1).alias("region"), F.col("article_date").alias("run_date"))
    root = _scratch(spark, "tree")
    (rows.repartition("region", "run_date").write.partitionBy("region", "run_date").option("header", True).option("escape", '"').csv(f"{root}/flat"))
    # The tree's file names: one file a region and day, moved to its place.
    fs, p = io._fs(spark, f"{root}/flat/region=*/run_date=*/part-*.csv")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for st in fs.globStatus(p) or []:
        region, day = (x.split("=")[1] for x in st.getPath().toString().split("/")[-3:-1])
        kind = "states" if region in dims.STATES else "union-territories"
        folder = path(f"{root}/tree/{kind}/{region}/Monsoon/{day.replace('-', '/')}")
        fs.mkdirs(folder)
        fs.rename(st.getPath(), path(folder, "results.csv"))
    back = io.links_for_dates(io.read_links(spark, f"{root}/tree"), "2000-12-31", 6)
    return back.select("Link", "Title", "Summary", "region", "run_date")


@register("articles_roundtrip",
          _final_sql("SELECT extraction_quality, count(*) AS n FROM f WHERE extraction_quality IN ('high', 'medium') "
                     "GROUP BY 1"), "A4/A7/B9")
def articles_roundtrip(spark, sf):
    final = D.smart_dedup(A.articles(spark, sf), "best")
    root = _scratch(spark, "articles")
    io.write_articles(final.drop("seq", "doc_id"), root, "2026-08-08")
    back = io.main_articles(io.read_articles(spark, root))
    return back.groupBy("extraction_quality").agg(F.count(F.lit(1)).alias("n"))


def _run_stats_sql():
    from quern.plans.catalog import QUERIES
    return QUERIES["run_stats"].sql


@register("run_stats_roundtrip", _run_stats_sql(), "A5/A8/F6")
def run_stats_roundtrip(spark, sf):
    # The survivors are made once, as both days' statistics count them.
    final = shared_table(D.smart_dedup(A.articles(spark, sf), "best",
                                       ["doc_id", "extraction_quality", "state", "article_language", "disaster_type"]), "stats-survivors")
    root = _scratch(spark, "stats")
    for day in ("2026-08-07", "2026-08-08"):
        G_stats = G.run_stats(final, extraction_date=day, extraction_timestamp=f"{day} 05:00:00")
        io.write_run_stats(G_stats, os.path.join(root, day))
    latest = io.latest_run_stats(io.read_run_stats(spark, os.path.join(root, "*")).drop("file"))
    return G.flatten_run_stats(latest)


# ------------------------------------------------------------------ further round trips

@register("articles_two_days",
          _final_sql("SELECT day AS extraction_date, extraction_quality, count(*) AS n FROM f, "
                     "(VALUES ('2026-08-07'), ('2026-08-08')) t(day) GROUP BY 1, 2"), "A4 (two days)")
def articles_two_days(spark, sf):
    # The survivors are made once, as both days' articles are written from them.
    final = shared_table(D.smart_dedup(A.articles(spark, sf), "best").drop("seq", "doc_id"), "two-days-survivors")
    root = _scratch(spark, "two-days")
    for day in ("2026-08-07", "2026-08-08"):
        io.write_articles(final, root, day)
    back = io.read_articles(spark, root)
    return back.groupBy(F.col("extraction_date").cast("string"), "extraction_quality").agg(F.count(F.lit(1)).alias("n"))


@register("write_links_range",
          f"""SELECT link AS "Link", DATE '2000-12-31' AS run_date, arg_min(title, seq) AS "Title" FROM {KEPT_SQL}
              WHERE TRY_CAST(substring(ist_date, 1, 10) AS DATE) BETWEEN DATE '2000-12-01' AND DATE '2000-12-31' GROUP BY link""", "A3")
def write_links_range(spark, sf):
    """The range is written twice; the second write clears the first."""
    d = B.strict_date_filter(A.dated_links(spark, sf), START, END).where(F.col("article_date").isNotNull())
    rows = d.select("seq", F.col("title").alias("Title"), F.col("link").alias("Link"), F.col("ist_date").alias("Date"),
                    F.lit("").alias("Source"), F.col("summary").alias("Summary"), F.lit("Monsoon").alias("Term"),
                    F.lit("en").alias("LanguageQueried"), F.lit("states").alias("region_type"), F.lit("assam").alias("region"),
                    F.lit("Monsoon").alias("disaster_type"))
    # The function takes the rows of one run; those of the range are taken here.
    rows = rows.where(F.try_to_date(F.substring("Date", 1, 10), "yyyy-MM-dd").between("2000-12-01", "2000-12-31"))
    rows = shared_table(rows, "range-links")  # dated once, as both writes take them
    root = _scratch(spark, "range")
    for _ in range(2):
        io.replace_links(rows, root, "2000-12-01", "2000-12-31")
    return io.read_links_hive(spark, root).select("Link", "run_date", "Title")


@register("feed_roundtrip",
          f"SELECT title, link, published, CASE WHEN seq % 3 = 0 THEN '' ELSE summary END AS summary, "
          f"CASE WHEN seq % 2 = 0 THEN 'desk' ELSE '' END AS source_title FROM {LINKS_SQL}", "A9")
def feed_roundtrip(spark, sf):
    d = A.dated_links(spark, sf)
    path = _scratch(spark, "feed")
    (d.select("title", "link", "published", F.when(F.col("seq") % 3 != 0, F.col("summary")).alias("summary"),
              F.when(F.col("seq") % 2 == 0, F.struct(F.lit("desk").alias("title"))).alias("source"))
     .write.json(path))
    return io.read_feed(spark, path)


@register("directory_roundtrip",
          "SELECT n_name AS state, s_name AS newspaper FROM supplier JOIN nation ON s_nationkey = n_nationkey", "A6")
def directory_roundtrip(spark, sf):
    n = A.table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    d = A.table(spark, sf, "supplier").join(n, "s_nationkey").select(
        F.col("n_name").alias("State/UT"), F.col("s_name").alias("Newspaper Name"),
        F.lit("https://x, \"y\"").alias("Website"), F.lit("English").alias("Language(s)"))
    path = _scratch(spark, "directory")
    d.write.option("header", True).option("escape", '"').csv(path)
    back = io.read_source_directory(spark, path)
    return back.select(F.col("State/UT").alias("state"), F.col("Newspaper Name").alias("newspaper"))


@register("region_selection",
          f"""SELECT seq FROM {LINKS_SQL} WHERE {'[' + ', '.join(repr(r) for r in REGIONS) + ']'}[CAST(seq % {len(REGIONS)} AS INTEGER) + 1] = 'assam'""",
          "B10")
def region_selection(spark, sf):
    arr = F.array(*[F.lit(r) for r in REGIONS])
    d = A.dated_links(spark, sf).select("seq", F.try_element_at(arr, (F.col("seq") % len(REGIONS)).cast("int") + 1).alias("region"))
    return B.region_selection(d, "assam").select("seq")


@register("run_stats_deduplication",
          f"SELECT original AS original_count, final AS final_count, removal_pct AS removal_percentage, "
          f"removed_url AS url_duplicates_removed, removed_title AS title_duplicates_removed, "
          f"removed_content AS content_duplicates_removed FROM ({FUNNEL_SQL})", "F6/F8 (deduplication block)")
def run_stats_deduplication(spark, sf):
    """The block as a later reader finds it in the written statistics."""
    # Keys and grade are made once a text, and the stages run once; funnel and statistics read both from tables.
    counted = ["extraction_quality", "state", "article_language", "disaster_type"]
    keys = shared_table(D.dedup_keys(A.articles(spark, sf), counted), "stats-keys")
    chain = shared_table(D.dedup_chain(keys.drop(*counted), "best"), "stats-chain")
    funnel = G.dedup_funnel(chain)
    root = _scratch(spark, "stats-dedup")
    io.write_run_stats(G.run_stats(D.smart_dedup(keys, "best", chain=chain), "2026-08-08", "2026-08-08 05:00:00", funnel=funnel), root)
    return io.latest_run_stats(io.read_run_stats(spark, root).drop("file")).select("deduplication.*")
