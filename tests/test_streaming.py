"""Streaming jobs against their batch forms on a small landed events file."""

import datetime as dt
import os
import random
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq

from quern.plans import adapters as A
from quern.streaming import jobs as S


def _events_dir():
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        rows.append({"event_id": i, "ts": t0 + dt.timedelta(seconds=rnd.randint(0, 6 * 3600)),
                     "user_id": rnd.randint(0, 4), "event_type": rnd.choice(["error", "error", "view", "click"]),
                     "value": 1.0, "props": "{}"})
    d = tempfile.mkdtemp(prefix="quern-events-")
    pq.write_table(pa.Table.from_pylist(rows), os.path.join(d, "events.parquet"))
    return d, rows


def _log(spark, d):
    return A.request_log_of(S.table_stream(spark, d, "events", S.EVENTS_SCHEMA))


def _closed(rows, hours):
    """The moment the watermark has passed: the latest event less its delay."""
    return max(r["ts"] for r in rows) - dt.timedelta(hours=hours)


def test_failure_alerts_count_failures_of_closed_windows(spark):
    d, rows = _events_dir()
    out = S.run_available_now(S.stream_failure_alerts(_log(spark, d), "30 minutes", 5, "1 hour"), "alerts-test")
    want: dict = {}
    for r in rows:
        if r["event_type"] == "error":
            at = r["ts"].replace(minute=r["ts"].minute // 30 * 30, second=0)
            want[at, r["user_id"]] = want.get((at, r["user_id"]), 0) + 1
    want = {k: n for k, n in want.items() if n >= 5 and k[0] + dt.timedelta(minutes=30) <= _closed(rows, 1)}
    assert {(r.window_start, r.key): r.failures for r in out.collect()} == want and want


def test_request_health_stream_equals_batch(spark):
    from quern.operators.requests import request_health
    d, rows = _events_dir()
    for slide in (None, "30 minutes"):
        stream = S.run_available_now(S.stream_request_health(_log(spark, d), "1 hour", slide, "1 hour"), "health-test")
        batch = request_health(A.request_log_of(spark.read.parquet(os.path.join(d, "events.parquet"))), "1 hour", slide)
        end = _closed(rows, 1)
        norm = lambda df: sorted((str(r.window_start)[:19], r.key, r.requests, r.successful) for r in df.collect()
                                 if r.window_start.replace(tzinfo=None) + dt.timedelta(hours=1) <= end)
        got = norm(stream)
        assert got == norm(batch) and len(got) == stream.count() > 0


def test_late_rows_of_closed_windows_are_left_out(spark):
    """Files arrive one by one; a row whose window the watermark has closed before changes nothing.

    The watermark follows one batch behind, so the row of the third file is
    late only once the second file's moment has been taken over.
    """
    d = tempfile.mkdtemp(prefix="quern-late-")
    t0 = dt.datetime(2024, 1, 1)

    def land(name, at):
        os.makedirs(os.path.join(d, name))
        pq.write_table(pa.Table.from_pylist([{"event_id": i, "ts": t0 + dt.timedelta(hours=h), "user_id": 1, "event_type": "error",
                                              "value": 1.0, "props": "{}"} for i, h in enumerate(at)]),
                       os.path.join(d, name, "events.parquet"))
    for i, at in enumerate([[0.1, 0.2], [9.0], [9.1], [0.3], [20.0], [30.0]]):
        land(f"p{i}", at)
        os.utime(os.path.join(d, f"p{i}", "events.parquet"), (1_700_000_000 + i * 10,) * 2)
    log = A.request_log_of(spark.readStream.format("parquet").schema(S.EVENTS_SCHEMA).option("maxFilesPerTrigger", 1)
                           .option("recursiveFileLookup", True).load(d))
    out = S.run_available_now(S.stream_request_health(log, "1 hour", None, "1 hour"), "late-test")
    assert {(r.window_start.hour, r.requests) for r in out.collect()} == {(0, 2), (9, 2), (20, 1)}


def test_link_stream_equals_batch_distinct_links(spark):
    from conftest import SF
    from quern.operators import filters as B
    from quern.plans.q_dates import CONTEXT, END, START, TERMS
    stream = S.run_available_now(S.stream_links(A.dated_links_of(
        S.table_stream(spark, SF, "orders", S.ORDERS_SCHEMA)), TERMS, START, END, context=CONTEXT)
        .drop("event_ts"), "links-test")
    batch = B.collect_entries(A.dated_links(spark, SF), TERMS, START, END, "Monsoon", "en", context=CONTEXT)
    assert sorted(r.Link for r in stream.collect()) == sorted({r.Link for r in batch.collect()})
