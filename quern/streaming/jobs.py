"""Structured Streaming jobs.

J1 ``stream_links``      — feed entries → relevance + date filter → per-link
                           dedup across micro-batches (watermarked).
J2 ``stream_request_health`` — requests / success % per key per event-time
                           window (tumbling or sliding), watermarked, append.
J3 ``stream_failure_alerts`` — windows in which a key failed too often.

``run_available_now`` drives a stream to the end of its input
(``trigger(availableNow=True)``) into a parquet folder under the shared
checkpoint directory and returns the result as a batch DataFrame; that
is how the streaming twins are compared with their batch forms.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import relevance as R
from quern.operators import filters as B
from quern.session import checkpoint_dir

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
ORDERS_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                 "o_orderdate timestamp_ntz, o_orderpriority string")


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """A file stream over one table of ``sf_dir`` (new files are new micro-batches)."""
    return (spark.readStream.format("parquet").schema(schema)
            .option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", 1)
            .load(sf_dir))


def run_available_now(stream: DataFrame, name: str) -> DataFrame:
    """Run ``stream`` to the end of its input in append mode, read the output back."""
    spark = stream.sparkSession
    base = os.path.join(checkpoint_dir(spark), f"stream-{name}-{uuid.uuid4().hex[:8]}")
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "_checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(os.path.join(base, "out"))


# ------------------------------------------------------------------ J1

def stream_links(entries: DataFrame, terms, start: str, end: str, watermark: str = "30 days",
                 irrelevant=R.IRRELEVANT, context=R.CONTEXT) -> DataFrame:
    """B7 filters on a stream, then each link kept once while within the
    watermark (``dropDuplicatesWithinWatermark``)."""
    kept = B.collect_entries(entries, terms, start, end, "Monsoon", "en", irrelevant=irrelevant,
                             context=context, keep_status=True)
    kept = kept.withColumn("event_ts", F.to_timestamp("Date"))
    return kept.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark(["Link"])


# ------------------------------------------------------------------ J2

def stream_request_health(log: DataFrame, duration: str = "1 hour", slide: str | None = None,
                          watermark: str = "2 hours", key: str = "key") -> DataFrame:
    """Requests and success % per key per tumbling or sliding window of event
    time.  In append mode a window is emitted, and its state dropped, once
    the watermark has passed its end."""
    x = log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    window = F.window("ts", duration, slide) if slide else F.window("ts", duration)
    return (x.groupBy(window.alias("window"), key)
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if("success").alias("successful"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key,
                    "requests", "successful", (F.col("successful") / F.col("requests") * 100).alias("success_rate")))


# ------------------------------------------------------------------ J3

#: Failures of a key within a window that raise an alert.
FAILURE_THRESHOLD = 5


def stream_failure_alerts(log: DataFrame, duration: str = "5 minutes", threshold: int = FAILURE_THRESHOLD,
                          watermark: str = "2 hours", key: str = "key") -> DataFrame:
    """Windows in which a key failed at least ``threshold`` times: a plain
    windowed count per key, whose state goes with the watermark."""
    x = (log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark).where(~F.col("success")))
    return (x.groupBy(F.window("ts", duration).alias("window"), key).agg(F.count(F.lit(1)).alias("failures"))
            .where(F.col("failures") >= threshold)
            .select(F.col("window.start").alias("window_start"), key, "failures"))
