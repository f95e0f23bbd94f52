"""Streaming queries (J1–J3), each driven to the end of its input.

A stream in append mode emits the windows its watermark has closed; the
oracles therefore count the windows that end at or before the latest event
less the watermark, rounded to the moment the last batch saw.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.plans import adapters as A
from quern.plans.catalog import register
from quern.plans.q_dates import COLLECT_LINKS_SQL, CONTEXT, END, START, TERMS
from quern.streaming import jobs as S

LOG = A.REQUEST_LOG_SQL
CLOSED = f"(SELECT max(ts) - INTERVAL 2 HOUR FROM {LOG})"


def log_stream(spark, sf):
    return A.request_log_of(S.table_stream(spark, sf, "events", S.EVENTS_SCHEMA))


@register("stream_links", COLLECT_LINKS_SQL, "J1")
def stream_links(spark, sf):
    o = S.table_stream(spark, sf, "orders", S.ORDERS_SCHEMA)
    s = S.stream_links(A.dated_links_of(o), TERMS, START, END, context=CONTEXT)
    return S.run_available_now(s.select("Link"), "links")


@register("stream_request_health",
          f"""SELECT date_trunc('hour', ts) AS window_start, key, count(*) AS requests,
                 count(*) FILTER (WHERE success) AS successful,
                 count(*) FILTER (WHERE success) / count(*) * 100 AS success_rate
              FROM {LOG} GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED}""", "J2")
def stream_request_health(spark, sf):
    out = S.run_available_now(S.stream_request_health(log_stream(spark, sf)), "health")
    return out.drop("window_end").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("stream_request_health_sliding",
          f"""SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, key, count(*) AS requests,
                 count(*) FILTER (WHERE success) AS successful,
                 count(*) FILTER (WHERE success) / count(*) * 100 AS success_rate
              FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS w
                    FROM {LOG}) GROUP BY 1, 2, 3 HAVING w + INTERVAL 1 HOUR <= {CLOSED}""", "J2 (sliding)")
def stream_request_health_sliding(spark, sf):
    out = S.run_available_now(S.stream_request_health(log_stream(spark, sf), "1 hour", "30 minutes"), "sliding")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@register("stream_failure_alerts",
          f"""SELECT date_trunc('day', ts) AS window_start, key, count(*) AS failures
              FROM {LOG} WHERE NOT success GROUP BY 1, 2
              HAVING count(*) >= 2 AND date_trunc('day', ts) + INTERVAL 1 DAY <= {CLOSED}""", "J3")
def stream_failure_alerts(spark, sf):
    s = S.stream_failure_alerts(log_stream(spark, sf), "1 day", 2)
    out = S.run_available_now(s, "alerts")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
