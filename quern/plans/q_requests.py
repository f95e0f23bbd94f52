"""Request-log queries over ``events``: C20, C21, F10, F12, G7–G9, H3, E9, J2 twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import errors as E
from quern.operators import joins as J
from quern.operators import requests as R
from quern.plans import adapters as A
from quern.plans import oracle as O
from quern.plans.catalog import register

LOG = A.REQUEST_LOG_SQL
LANGS = ["en", "hi", "ta", "bn"]


def log(spark, sf):
    return A.request_log(spark, sf)


def _lang_col():
    return F.try_element_at(F.array(*[F.lit(x) for x in LANGS]), (F.col("key") % len(LANGS)).cast("int") + 1)


LANG_SQL = f"[{', '.join(O.lit(x) for x in LANGS)}][CAST(key % {len(LANGS)} AS INTEGER) + 1]"


def _classify_sql(x: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower(coalesce({x}, '')), {O.lit(w)})" for w in words) + f" THEN '{cls}'"
        for cls, words in E.ERROR_CLASSES)
    return f"(CASE {whens} ELSE 'unknown_error' END)"


def _fatal_sql(x: str) -> str:
    return "(" + " OR ".join(f"contains(coalesce({x}, ''), {O.lit(w)})" for w in E.FATAL_INDICATORS) + ")"


@register("classify_errors",
          f"SELECT event_id, {_classify_sql('error_type')} AS error_class, {_fatal_sql('error_type')} AS fatal "
          f"FROM {LOG} WHERE NOT success", "C20/C21")
def classify_errors(spark, sf):
    lg = log(spark, sf).where(~F.col("success"))
    return lg.select("event_id", E.classify_error("error_type").alias("error_class"),
                     E.is_fatal_error("error_type").alias("fatal"))


# Window-function forms of the positions, used by every ordered oracle below.
POS_SQL = (f"(SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) - 1 AS pos, "
           f"sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts, event_id "
           f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_ok FROM {LOG})")


@register("request_stats",
          f"""WITH l AS {POS_SQL}, p AS (SELECT key, count(*) AS requests, count(*) FILTER (WHERE success) AS successful,
                 max(pos) FILTER (WHERE success) AS last_ok FROM l GROUP BY key)
              SELECT p.key, requests, successful, successful / requests * 100 AS success_rate,
                     (SELECT count(*) FROM l WHERE l.key = p.key AND NOT l.success AND (p.last_ok IS NULL OR l.pos > p.last_ok))
                       AS consecutive_failures FROM p""", "F12")
def request_stats(spark, sf):
    return R.request_stats(log(spark, sf))


@register("request_totals",
          f"SELECT count(*) AS total_requests, count(*) FILTER (WHERE success) AS successful_requests, "
          f"count(*) FILTER (WHERE success) / count(*) * 100 AS success_rate FROM {LOG}", "F12")
def request_totals(spark, sf):
    return R.request_totals(log(spark, sf))


@register("failure_streak",
          f"""SELECT key, n_ok AS island, count(*) AS length, min(ts) AS start_ts, max(ts) AS end_ts, min(pos) AS start_pos
              FROM {POS_SQL} WHERE NOT success GROUP BY key, n_ok""", "G7")
def failure_streak(spark, sf):
    return R.failure_streaks(log(spark, sf))


@register("rolling_failure_rate",
          f"""SELECT key, event_id, ts, pos, CAST(f AS BIGINT) AS recent_failures, f / 10 AS failure_rate,
                 CASE WHEN f / 10 > 0.5 THEN 'high' WHEN f / 10 > 0.3 THEN 'elevated' ELSE 'normal' END AS band
              FROM (SELECT *, sum(CASE WHEN success THEN 0 ELSE 1 END) OVER (PARTITION BY key ORDER BY ts, event_id
                     ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS f FROM {POS_SQL}) WHERE pos >= 9""", "G8")
def rolling_failure_rate(spark, sf):
    return R.rolling_failure_rate(log(spark, sf), 10)


@register("recent_failure_pattern",
          f"""SELECT key, event_id, ts, pos, CAST(f AS BIGINT) AS recent_failures, f / 5 AS failure_rate,
                 CASE WHEN f / 5 > 0.5 THEN 'high' WHEN f / 5 > 0.3 THEN 'elevated' ELSE 'normal' END AS band
              FROM (SELECT *, sum(CASE WHEN success THEN 0 ELSE 1 END) OVER (PARTITION BY key ORDER BY ts, event_id
                     ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS f FROM {POS_SQL}) WHERE pos >= 4""", "G8 (last 5)")
def recent_failure_pattern(spark, sf):
    return R.rolling_failure_rate(log(spark, sf), 5)


# Four requests of a key in a row make a search here.
SEARCH_SQL = f"(SELECT *, pos // 4 AS search_id, {LANG_SQL} AS lang FROM {POS_SQL})"


def search_log(spark, sf):
    return R.with_positions(log(spark, sf)).withColumn("search_id", F.floor(F.col("pos") / 4)).drop("pos", "n_ok", "n_fail")


@register("banned_patterns",
          f"""WITH s AS (SELECT *, pos - coalesce(max(CASE WHEN success THEN pos END) OVER (PARTITION BY key ORDER BY ts, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), -1) AS streak FROM {SEARCH_SQL})
              SELECT key, search_id, lang, 'q' || CAST(key AS VARCHAR) || '-' || CAST(search_id AS VARCHAR) AS query,
                     substring(md5('q' || CAST(key AS VARCHAR) || '-' || CAST(search_id AS VARCHAR) || '_' || lang), 1, 8) AS pattern
              FROM s GROUP BY key, search_id, lang
              HAVING count(*) FILTER (WHERE success) = 0 AND count(*) = 4 AND arg_max(streak, pos) >= 3""", "G9")
def banned_patterns(spark, sf):
    return R.banned_patterns(search_log(spark, sf), _lang_col(), attempts=4)


@register("query_success_by_language",
          f"""WITH q AS (SELECT key, search_id, lang, count(*) FILTER (WHERE success) AS ok FROM {SEARCH_SQL} GROUP BY ALL)
              SELECT lang, count(*) AS queries, count(*) FILTER (WHERE ok > 0) AS with_results,
                     round_even(CAST(count(*) FILTER (WHERE ok > 0) AS DOUBLE) / count(*) * 100, 2) AS success_pct
              FROM q GROUP BY lang""", "F10")
def query_success_by_language(spark, sf):
    return R.query_success_by_language(search_log(spark, sf), _lang_col())


@register("top_keys_by_success",
          f"""SELECT key, count(*) AS requests, count(*) FILTER (WHERE success) AS successful,
                 count(*) FILTER (WHERE success) / count(*) * 100 AS success_rate
              FROM {LOG} GROUP BY key ORDER BY success_rate DESC, key LIMIT 5""", "H3")
def top_keys_by_success(spark, sf):
    s = log(spark, sf).groupBy("key").agg(F.count(F.lit(1)).alias("requests"), F.count_if("success").alias("successful"))
    s = s.withColumn("success_rate", F.col("successful") / F.col("requests") * 100)
    return R.top_keys_by_success(s, 5)


@register("request_health_hourly",
          f"""SELECT date_trunc('hour', ts) AS window_start, key, count(*) AS requests,
                 count(*) FILTER (WHERE success) AS successful,
                 count(*) FILTER (WHERE success) / count(*) * 100 AS success_rate
              FROM {LOG} GROUP BY 1, 2""", "J2 (batch twin)")
def request_health_hourly(spark, sf):
    return R.request_health(log(spark, sf), "1 hour")


@register("coverage_gaps",
          """WITH days AS (SELECT CAST(d AS DATE) AS day FROM range(DATE '2024-01-01', DATE '2025-01-01', INTERVAL 1 DAY) t(d)),
             spine AS (SELECT n_name AS region, day FROM nation, days),
             hits AS (SELECT DISTINCT n.n_name AS region, CAST(e.ts AS DATE) AS day FROM events e
                      JOIN nation n ON n.n_nationkey = e.user_id % 25)
             SELECT s.region, s.day FROM spine s ANTI JOIN hits h ON s.region = h.region AND s.day = h.day""", "E9")
def coverage_gaps(spark, sf):
    nation = A.table(spark, sf, "nation").select(F.col("n_nationkey"), F.col("n_name").alias("region"))
    ev = A.table(spark, sf, "events").select((F.col("user_id") % 25).cast("int").alias("n_nationkey"),
                                             F.to_date("ts").alias("day"))
    counts = ev.join(nation, "n_nationkey").select("region", "day")
    return J.coverage_gaps(nation.select("region"), counts, "2024-01-01", "2024-12-31")
