"""Hard negatives by the threshold algorithm against brute force, and their edge cases."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from quern.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<double>, label int, anchor_id string, v string, windows string"


def brute(rows, positives=5, negatives=3, every=50):
    use = set()
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        use.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * c) for c in vector)))
    out = set()
    for a in use:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1] == a[1])
                        for b in use if b[0] != a[0] and len(a[2]) == len(b[2]))
        scored = [x for x in scored if -2 ** 63 < x[0] < 2 ** 63]  # left out: what no long holds
        for s, p in [(-s, i) for s, i, same in scored if same][:positives]:
            near = [(-t, i) for t, i, same in scored if not same and 50 * s <= -100 * t <= 95 * s][:negatives]
            out |= {(a[0], p, r + 1, i, s, t) for r, (t, i) in enumerate(near)}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = H.mine(df, label=H.relabel(df["vec_id"], df["label"]), **options).collect()
    assert len(got) == len({(x.anchor_id, x.positive_id, x.rank) for x in got})
    return {(x.anchor_id, x.positive_id, x.rank, x.negative_id, x.positive_score, x.negative_score) for x in got}


def test_equals_brute_force_over_blocks_ties_and_gaps(spark):
    rng = random.Random(5)
    rows = []
    for i in range(700):
        kind = rng.random()
        v = [rng.choice([-0.02, 0.0, 0.011, 0.5, -1.3, rng.gauss(0, 1)]) for _ in range(6)]
        if kind < 0.3:
            v = [0.25, -0.5, 0.0, 1.0, 1.0, -0.001]      # a vector that a third of all rows share
        elif kind < 0.35:
            v = v[:3]                                    # another length
        elif kind < 0.37:
            v = []
        elif kind < 0.43:
            v[2] = rng.choice([None, math.nan, math.inf])
        elif kind < 0.45:
            v = None
        label = None if rng.random() < 0.03 else (3 if rng.random() < 0.5 else rng.randrange(10))
        rows.append((None if rng.random() < 0.01 else i, v, label, "x", "y", "z"))
    rows += rng.sample(rows, 100)                        # rows repeated whole
    want = brute(rows, every=10)
    assert len(want) > 300
    assert mined(spark, rows, anchors_every=10, block_rows=128, ask_rows=16) == want
    assert mined(spark, rows, anchors_every=10) == want


def test_wide_numbers_are_exact(spark):
    rng = random.Random(6)
    for size in (1e7, 3e9, 1e14):
        rows = [(i, [rng.uniform(-size, size) for _ in range(3)], rng.randrange(3), "", "", "") for i in range(60)]
        assert mined(spark, rows, anchors_every=10) == brute(rows, every=10)


def test_no_anchor_no_partner_empty(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(1, [1.0], 2, "", "", "")]) == set()
    assert mined(spark, [(50, [1.0], 2, "", "", ""), (51, [0.9], 3, "", "", "")]) == set()
    zero = [(i, [0.0, 0.0], i % 2, "", "", "") for i in range(50, 63)]
    assert mined(spark, zero) == brute(zero) != set()


def test_reading_stops_strictly_below_the_kth_score():
    rng = np.random.default_rng(7)
    values = np.floor(rng.normal(size=(5000, 3)) * 256)
    lists = H.Lists(values)
    q = np.floor(rng.normal(size=3) * 256)
    at, s, read = H.threshold_search(lists, q, [(H.LEAST, H.MOST)], 3)
    assert read < 2500 and sorted(s)[-3:] == sorted(values @ q)[-3:]
    # All entries tie: nothing may be left unread, as an unread one could have a smaller id.
    same = H.Lists(np.ones((300, 2)))
    assert H.threshold_search(same, np.array([1.0, 1.0]), [(H.LEAST, H.MOST)], 3, first_read=8)[2] == 300


def test_registered_query_columns(spark):
    from conftest import SF
    from quern.llm import queries as Q
    got = Q.op13_threshold_negatives(spark, SF)
    assert got.columns[:6] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = got.filter(F.col("rank") > 3).count()
    assert rows == 0
