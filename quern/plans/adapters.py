"""Bindings of the driver tables onto the corpus data model.

The reference works on link rows, articles and a request log; the test
tables are ``documents``, ``pages``, ``orders`` and ``events``.  Each
adapter is a pure projection (no shuffle), so Catalyst prunes columns
and pushes filters straight into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import quality as Q
from quern.functions import text as T
from quern.functions import url as U

DISASTER = "Monsoon"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def article_url(doc_id) -> F.Column:
    """Four documents per URL over two hosts, so every dedup stage bites."""
    g = F.floor(doc_id / 4).cast("bigint")
    return F.concat(F.lit("https://d"), (g % 2).cast("string"), F.lit(".example.com/a/"), g.cast("string"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents → article rows (§1 Article) with a stable ``seq``."""
    d = table(spark, sf_dir, "documents")
    final_url = article_url(F.col("doc_id"))
    title = T.first_line("text")
    return d.select(
        F.col("doc_id").alias("seq"),
        F.col("doc_id"),
        title.alias("title"),
        final_url.alias("final_url"),
        final_url.alias("original_url"),
        U.normalize_url(final_url).alias("normalized_url"),
        F.col("text").alias("article_text"),
        F.col("lang").alias("article_language"),
        F.col("source").alias("state"),
        F.lit(DISASTER).alias("disaster_type"),
        Q.quality_grade("text").alias("extraction_quality"),
    )


def dated_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → feed entries with an RFC-822 ``published`` and a dated URL.

    ``ts`` = order date + (orderkey % 24) hours, so the IST shift crosses
    midnight; the URL carries the date in one of nine layouts; every 50th
    ``published`` is unparseable.
    """
    return dated_links_of(table(spark, sf_dir, "orders"))


def dated_links_of(o: DataFrame) -> DataFrame:
    """The dated-links projection of an orders frame (batch or stream)."""
    k = F.col("o_orderkey")
    ts = F.col("o_orderdate") + F.make_interval(hours=(k % 24).cast("int"))
    y, m, d = F.year(ts), F.month(ts), F.dayofmonth(ts)
    yy = y.cast("string")
    mm, dd = F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")
    layout = (k % 9).cast("int")
    path = (F.when(layout == 0, F.concat_ws("/", yy, m.cast("string"), d.cast("string"), F.lit("story")))
            .when(layout == 1, F.concat(yy, F.lit("-"), m.cast("string"), F.lit("-"), d.cast("string"), F.lit("/story")))
            .when(layout == 2, F.concat(F.lit("story"), yy, mm, dd, F.lit(".html")))
            .when(layout == 3, F.concat(F.lit("article"), yy, mm, dd))
            .when(layout == 4, F.concat(dd, F.lit("-"), mm, F.lit("-"), yy, F.lit("/story")))
            .when(layout == 5, F.concat(dd, mm, yy, F.lit("/story")))
            .when(layout == 6, F.concat(F.lit("news/"), yy, F.lit("/"), m.cast("string"), F.lit("/"), d.cast("string"), F.lit("/x")))
            .when(layout == 7, F.concat(d.cast("string"), F.lit("_"), m.cast("string"), F.lit("_"), yy))
            .otherwise(F.concat(F.lit("x-"), yy, mm, dd, F.lit("-y"))))
    published = (F.when(k % 50 == 0, F.concat(F.lit("garbage "), k.cast("string")))
                 .otherwise(F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))))
    return o.select(
        k.alias("seq"),
        ts.alias("ts"),
        published.alias("published"),
        F.concat(F.lit("https://news"), (k % 7).cast("string"), F.lit(".example.in/"), path).alias("link"),
        F.concat(F.col("o_orderpriority"), F.lit(" "), F.col("o_orderstatus")).alias("title"),
        F.concat(F.lit("total "), F.col("o_totalprice").cast("string")).alias("summary"),
    )


# Test vectors: error texts a feed client typically reports; the adapter
# assigns one to each failed event by event_id, so every class is hit.
ERROR_TEXTS = ["HTTPSConnectionPool: Max retries exceeded with url",
               "SSLError: EOF occurred in violation of protocol",
               "ConnectionError: RemoteDisconnected",
               "ReadTimeout: read timed out",
               "403 Client Error: Forbidden",
               "404 Client Error: Not Found",
               "quota exceeded permanently",
               "Invalid API key",
               "unexpected response"]


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → request log (event_id, ts, key, success, error_type, response_time)."""
    return request_log_of(table(spark, sf_dir, "events"))


def request_log_of(e: DataFrame) -> DataFrame:
    """The request-log projection of an events frame (batch or stream)."""
    texts = F.array(*[F.lit(t) for t in ERROR_TEXTS])
    err = F.try_element_at(texts, (F.col("event_id") % len(ERROR_TEXTS)).cast("int") + 1)
    return e.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id").alias("key"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") == "error", err).alias("error_type"),
        F.col("value").alias("response_time"),
    )


REQUEST_LOG_SQL = ("(SELECT event_id, ts, user_id AS key, event_type <> 'error' AS success, "
                   "CASE WHEN event_type = 'error' THEN ["
                   + ", ".join("'" + t.replace("'", "''") + "'" for t in ERROR_TEXTS)
                   + f"][CAST(event_id % {len(ERROR_TEXTS)} AS INTEGER) + 1] END AS error_type, "
                   "value AS response_time FROM events)")
