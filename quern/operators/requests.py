"""Request-log analytics (F10, F12, G7–G9, H3, J2 batch twin).

The log is ``(ts, key, success, error_type, response_time)`` plus a unique
``event_id`` that breaks timestamp ties.  Order-dependent measures
(streaks, rolling rates) are built from skew-safe running sums: a key that
produced a third of all requests is cut into time buckets, so no task
ever sorts a whole key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.aggs import pct
from quern.operators.ranking import running_sums

BUCKET_SECONDS = 3600


def time_bucket(ts: str = "ts", seconds: int = BUCKET_SECONDS) -> F.Column:
    """Bucket number of a timestamp (TIMESTAMP or TIMESTAMP_NTZ), ``seconds`` wide."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.floor(micros / F.lit(seconds * 1_000_000))


def with_positions(log: DataFrame, key: str = "key", ts: str = "ts", tiebreak: str = "event_id",
                   bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Adds ``pos`` (0-based request number per key), ``n_ok`` (successes so
    far, inclusive) and ``n_fail`` (failures so far, inclusive)."""
    x = running_sums(log, key, ts, {"pos": F.lit(1), "n_ok": F.col("success").cast("int")},
                     bucket=time_bucket(ts, bucket_seconds), tiebreak=tiebreak)
    x = x.withColumn("pos", F.col("pos") - 1)
    return x.withColumn("n_fail", F.col("pos") + 1 - F.col("n_ok"))


def failure_streaks(log: DataFrame, key: str = "key", min_len: int = 1, **kw) -> DataFrame:
    """G7 — runs of consecutive failures per key (a success resets the run).

    Island id = successes so far; a run is the failures of one island.
    """
    p = with_positions(log, key, **kw)
    fails = p.where(~F.col("success"))
    runs = (fails.groupBy(key, F.col("n_ok").alias("island"))
            .agg(F.count(F.lit(1)).alias("length"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
                 F.min("pos").alias("start_pos")))
    return runs.where(F.col("length") >= min_len)


def rolling_failure_rate(log: DataFrame, window: int = 10, key: str = "key", **kw) -> DataFrame:
    """G8 — failure share of the last ``window`` requests of the key, only
    once the key has that many; bands: high (>0.5), elevated (>0.3), normal.

    failures in (i-window, i] = n_fail(i) - n_fail(i-window), found by an
    equi-join on (key, pos) — no ordered window over the whole key.
    """
    p = with_positions(log, key, **kw)
    prev = p.select(F.col(key), (F.col("pos") + window).alias("pos"), F.col("n_fail").alias("_prev_fail"))
    j = p.where(F.col("pos") >= window - 1).join(prev, [key, "pos"], "left")
    fails = F.col("n_fail") - F.coalesce(F.col("_prev_fail"), F.lit(0))
    rate = fails / F.lit(window)
    return j.select(key, "event_id", "ts", "pos", fails.cast("bigint").alias("recent_failures"),
                    rate.alias("failure_rate"),
                    F.when(rate > 0.5, "high").when(rate > 0.3, "elevated").otherwise("normal").alias("band"))


def request_stats(log: DataFrame, key: str = "key") -> DataFrame:
    """F12 — per key: requests, successes, success % and the current streak
    of consecutive failures (failures after the key's last success)."""
    order = F.struct(F.col("ts"), F.col("event_id"))
    per = log.groupBy(key).agg(F.count(F.lit(1)).alias("requests"),
                               F.count_if("success").alias("successful"),
                               F.max(F.when(F.col("success"), order)).alias("_last_ok"))
    tail = (log.join(per.select(key, "_last_ok"), key)
            .where(~F.col("success") & (F.col("_last_ok").isNull() | (order > F.col("_last_ok"))))
            .groupBy(key).agg(F.count(F.lit(1)).alias("consecutive_failures")))
    return (per.join(tail, key, "left")
            .select(key, "requests", "successful",
                    (F.col("successful") / F.col("requests") * 100).alias("success_rate"),
                    F.coalesce("consecutive_failures", F.lit(0)).cast("bigint").alias("consecutive_failures")))


def request_totals(log: DataFrame) -> DataFrame:
    """F12 global row: totals and overall success %."""
    return log.agg(F.count(F.lit(1)).alias("total_requests"), F.count_if("success").alias("successful_requests")) \
        .select("total_requests", "successful_requests",
                F.when(F.col("total_requests") > 0,
                       F.col("successful_requests") / F.col("total_requests") * 100).otherwise(F.lit(0.0))
                .alias("success_rate"))


def banned_patterns(log: DataFrame, lang: F.Column, attempts: int = 4, key: str = "key",
                    search: str = "search_id", **kw) -> DataFrame:
    """G9 — searches whose ``attempts`` attempts all failed and at whose end the
    key's run of failures is at least 3 (so two attempts suffice after an
    earlier failure, and a search cut short is not banned); pattern id =
    first 8 hex digits of md5('{query}_{lang}').

    The run at a request is its number minus that of the key's last success.
    """
    p = with_positions(log, key, **kw).withColumn("_lang", lang)
    g = p.groupBy(key, search, "_lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("success").alias("ok"),
        F.max(F.struct("pos", "n_ok")).alias("last"))
    oks = p.where("success").select(F.col(key), F.col("n_ok").alias("_k"), F.col("pos").alias("_ok_pos"))
    q = F.concat(F.lit("q"), F.col(key).cast("string"), F.lit("-"), F.col(search).cast("string"))
    g = (g.where((F.col("ok") == 0) & (F.col("n") == attempts))
         .withColumn("_k", F.col("last.n_ok")).join(oks, [key, "_k"], "left")
         .withColumn("streak", F.col("last.pos") - F.coalesce("_ok_pos", F.lit(-1))))
    return (g.where(F.col("streak") >= 3)
            .select(key, search, F.col("_lang").alias("lang"), q.alias("query"),
                    F.substring(F.md5(F.concat(q, F.lit("_"), F.col("_lang"))), 1, 8).alias("pattern")))


def query_success_by_language(log: DataFrame, lang: F.Column, key: str = "key", search: str = "search_id") -> DataFrame:
    """F10 — per language, % of searches with at least one success."""
    per = log.withColumn("lang", lang).groupBy(key, search, "lang").agg(F.count_if("success").alias("ok"))
    return per.groupBy("lang").agg(F.count(F.lit(1)).alias("queries"),
                                   F.count_if(F.col("ok") > 0).alias("with_results")) \
        .select("lang", "queries", "with_results", pct("with_results", "queries").alias("success_pct"))


def top_keys_by_success(stats: DataFrame, k: int = 5, key: str = "key") -> DataFrame:
    """H3 — the k keys with the best success rate (ties → key)."""
    return stats.orderBy(F.desc("success_rate"), F.asc(key)).limit(k)


def request_health(log: DataFrame, duration: str = "1 hour", slide: str | None = None,
                   key: str = "key") -> DataFrame:
    """J2 (batch twin) — requests and success % per key per time window."""
    w = F.window("ts", duration, slide) if slide else F.window("ts", duration)
    return (log.groupBy(w.alias("window"), key)
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if("success").alias("successful"))
            .select(F.col("window.start").alias("window_start"), key, "requests", "successful",
                    (F.col("successful") / F.col("requests") * 100).alias("success_rate")))

