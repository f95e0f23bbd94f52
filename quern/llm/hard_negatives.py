"""Hard negatives by Fagin's threshold algorithm on integer inner products.

A vector's components become floor(256 x); a row's score for an anchor is
the integer inner product. An anchor's positives are its nearest rows of
its own label, and each positive opens a window of scores, a share of its
own, in which the nearest rows of other labels are its hard negatives.

Rows are dealt by a hash of their id into blocks, so neither a label nor a
vector that a third of all rows share makes a block large. A block keeps,
for every dimension, its entries sorted by that component. An anchor reads
all lists side by side, from the high end where its own component is
positive and from the low end where it is negative (a zero component reads
nothing), and scores every entry on first sight by its stored components.
The products at the places reached add up to the threshold, which no unread
entry exceeds; reading stops once the threshold lies strictly below the kth
score of every window, or below the window itself. Ties are thus read to
their end, and the answer is exact. Equal vectors of one label are one
entry with its smallest ids, as many as an answer can need.

Two rounds: the blocks' best rows of the anchor's label, merged, give the
positives, and these the windows of the second round. Every anchor meets
every block, once a round; an anchor brings its vector and windows, a block
gives at most ``k`` rows a window.

Nulls: rows with a null id, a null label, a null vector, or a null or
non-finite component take no part. A row repeated whole (id, label, vector)
counts once; rows that share an anchor's id are not candidates for it. An
id that stands for several different rows is as many anchors, whose answers
are merged; where they differ, a positive or negative id keeps its highest
score. Vectors meet vectors of their own length only; empty vectors score 0.
Ties go to the smaller id. Products are added in integers wide enough for
them; a pair whose score no long holds is left out. Empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import shared_table
from quern.session import ship_package

#: Candidates in a block and anchors that meet it at a time, about.
BLOCK_ROWS, ASK_ROWS = 8192, 4096
#: Entries of each list read before the threshold is looked at first; then twice as many each time.
FIRST_READ = 32
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def relabel(id_col: Column, label: Column) -> Column:
    """The rule of the query's table: ids divisible by 7 wear the next of ten labels."""
    return F.when(id_col % 7 == 0, (label.cast("bigint") + 1) % 10).otherwise(label.cast("bigint"))


class Lists:
    """A block's entries: their components, and their order in every dimension."""

    def __init__(self, values: np.ndarray):
        n, dims = values.shape
        most = int(np.abs(values).max(initial=0.0)) if values.size else 0
        if most >= 1 << 62:
            self.values = np.array([[int(x) for x in row] for row in values], object).reshape(n, dims)
        else:
            self.values = values.astype(np.float64 if dims * most * most < 1 << 53 else np.int64)
        self.most, self.dims = most, dims
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32).copy()  # rising, a row a dimension

    def typed(self, q: np.ndarray):
        """Components and anchor in a type that holds every sum exactly."""
        top = self.dims * self.most * int(np.abs(q).max(initial=0.0))
        if top < 1 << 53 and self.values.dtype == np.float64:
            return self.values, q.astype(np.float64)
        if top < 1 << 63 and self.values.dtype != object:
            return self.values.astype(np.int64), q.astype(np.int64)
        return (np.array([[int(x) for x in row] for row in self.values], object).reshape(self.values.shape),
                np.array([int(x) for x in q], object))


def threshold_search(lists: Lists, q: np.ndarray, windows: list[tuple[int, int]], k: int, allowed: np.ndarray | None = None,
                     first_read: int = FIRST_READ):
    """Entries and scores that hold, for each window (lowest, highest score), all of its k best and their ties.

    Returns (entries, scores, entries read): a superset of the answer, whose
    unread rest is strictly below every window's kth score.
    """
    n = len(lists.values)
    values, q = lists.typed(q)
    active = np.flatnonzero(q != 0)
    seen = np.zeros(n, bool)
    got, scores = [np.empty(0, np.int64)], [np.empty(0, values.dtype)]
    if not len(active):  # every score is 0
        at = np.arange(n) if allowed is None else np.flatnonzero(allowed)
        return at, np.zeros(len(at), values.dtype), n
    rising = (q[active] < 0)[:, None]
    order, depth, step = lists.order[active], 0, first_read
    open_ = [w for w in windows if w[0] <= w[1]]
    best: list[np.ndarray] = [np.empty(0, values.dtype)] * len(open_)
    while open_ and depth < n:
        to = min(n, depth + step)
        # Read places depth .. to - 1 of every list, from its own end.
        fresh = np.zeros(n, bool)
        fresh[np.where(rising, order[:, depth:to], order[:, n - to:n - depth]).ravel()] = True
        fresh &= ~seen
        new = np.flatnonzero(fresh)
        seen[new] = True
        if allowed is not None:
            new = new[allowed[new]]
        s = values[new] @ q
        got.append(new)
        scores.append(s)
        last = np.where(rising[:, 0], order[:, to - 1], order[:, n - to])
        threshold = (values[last, active] * q[active]).sum()
        still, kept = [], []
        for w, b in zip(open_, best):
            b = np.concatenate((b, s[(s >= w[0]) & (s <= w[1])]))
            if len(b) > k:
                b = np.sort(b)[-k:] if b.dtype == object else np.partition(b, len(b) - k)[len(b) - k:]
            if threshold >= w[0] and not (len(b) >= k and threshold < b.min()):
                still.append(w)
                kept.append(b)
        open_, best = still, kept
        depth, step = to, step * 2
    return np.concatenate(got), np.concatenate(scores), int(seen.sum())


def _entries(ids: np.ndarray, labels: np.ndarray, values: np.ndarray, most: int):
    """Distinct (label, vector) pairs and of each its smallest ``most`` ids."""
    both = np.ascontiguousarray(np.column_stack((labels.astype(np.float64), values + 0.0)))
    _, first, entry = np.unique(both.view(np.dtype((np.void, both.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
    by = np.lexsort((ids, entry))
    cut = np.flatnonzero(np.diff(entry[by])) + 1
    owners = [np.unique(ids[g])[:most] for g in np.split(by, cut)]
    return labels[first], values[first], owners


def _matrix(t: pa.Table) -> np.ndarray:
    rows = t.column("v").to_numpy()
    out = np.stack(rows).astype(np.float64) if t.num_rows else np.empty((0, 0))
    return out if out.shape[1] else np.zeros((len(rows), 1))


def _take(entries, scores, owners, window, k: int, not_id: int):
    """The k best (score, id) of a window, ties to smaller ids."""
    fits = np.flatnonzero((scores >= max(window[0], LEAST)) & (scores <= min(window[1], MOST)))
    if len(fits) > 4 * (k + 2) and scores.dtype != object:
        s = scores[fits]
        bar = np.partition(s, len(s) - k - 1)[len(s) - k - 1]  # one more: the best entry may be the anchor's own id
        fits = fits[s >= bar]
    found: dict[int, int] = {}
    for s, v in sorted((-int(scores[i]), int(v)) for i in fits.tolist() for v in owners[entries[i]] if v != not_id):
        if len(found) >= k:
            break
        found.setdefault(v, -s)
    return found


FOUND = "anchor_id bigint, window_id bigint, found_id bigint, score bigint"


def _meet(k: int, same: bool):
    """A block and the anchors that meet it: the best of every window, of the anchor's label or of others."""
    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        out: list = []
        if a.num_rows and b.num_rows:
            labels, values, owners = _entries(a.column("id").to_numpy(), a.column("label").to_numpy(), _matrix(a), k + 2)
            anchors, windows = _matrix(b), b.column("windows").to_pylist()
            own = b.column("label").to_numpy()
            groups = ([(np.flatnonzero(labels == x), np.flatnonzero(own == x)) for x in np.unique(own)]
                      if same else [(np.arange(len(labels)), np.arange(len(own)))])
            for rows, asked in groups:
                if not len(rows):
                    continue
                lists = Lists(values[rows])
                who = [owners[i] for i in rows.tolist()]
                for i in asked.tolist():
                    anchor, q = int(b.column("id")[i].as_py()), anchors[i]
                    spans = [(w["lo"], w["hi"]) for w in windows[i]]
                    allowed = None if same else labels[rows] != own[i]
                    # One more than k, as the best may be the anchor itself (or rows that share its id).
                    at, score, _ = threshold_search(lists, q, spans, k + 1, allowed)
                    for w, span in zip(windows[i], spans):
                        found = _take(at, score, who, span, k, anchor)
                        out += [(anchor, w["id"], v, s) for v, s in found.items()]
        cols = list(zip(*out)) or [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["anchor_id", "window_id", "found_id", "score"])
    return run


def _search(index: DataFrame, asked: DataFrame, k: int, same: bool, blocks: int, asks: int) -> DataFrame:
    """The k best of each (anchor, window): every block's, merged."""
    spread = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["dim", "block", "ask"]
    tasks = max(blocks * asks, 1)
    left = index.select(F.size("v").alias("dim"), spread(blocks).alias("block"), every(asks).alias("ask"), "id", "label", "v")
    right = asked.select(F.size("v").alias("dim"), every(blocks).alias("block"), spread(asks).alias("ask"), "id", "label", "v", "windows")
    met = left.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key)).applyInArrow(_meet(k, same), FOUND)
    best = met.groupBy("anchor_id", "window_id", "found_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("anchor_id", "window_id").orderBy(F.col("score").desc(), "found_id")
    return best.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def mine(df: DataFrame, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95, scale: int = 256,
         anchors_every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None,
         block_rows: int = BLOCK_ROWS, ask_rows: int = ASK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, and positive_rank.

    Anchors are the rows whose id is divisible by ``anchors_every``. ``label``
    is an expression over ``df`` (default its column label). A window runs from
    low_percent to high_percent of the positive's score, both included.
    """
    ship_package(df.sparkSession)
    x = df.select(F.col(id_col).cast("bigint").alias("id"), (label if label is not None else F.col("label")).cast("bigint").alias("label"),
                  F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = x.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(fine)
    # Whole numbers, still as doubles: a double holds floor(256 x) exactly whatever its size.
    whole = F.transform("v", lambda c: F.rint(c * scale) - F.when(F.rint(c * scale) > c * scale, 1.0).otherwise(0.0))
    index = shared_table(x.select("id", "label", whole.alias("v")), "whole-vectors")
    asked = shared_table(index.filter(F.col("id") % anchors_every == 0).distinct(), "anchors")
    blocks = max(1, -(-index.count() // block_rows))
    asks = max(1, -(-asked.count() // ask_rows))
    # Round 1: one window, all scores.
    all_scores = F.array(F.struct(F.lit(0).cast("bigint").alias("id"), F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi")))
    near = shared_table(_search(index, asked.withColumn("windows", all_scores), positives, True, blocks, asks)
                        .select("anchor_id", F.col("found_id").alias("positive_id"), F.col("rank").alias("positive_rank"),
                                F.col("score").alias("positive_score")), "positives")
    # Round 2: a window for each positive score.
    wide = F.col("positive_score").cast("decimal(25,0)")
    lo = F.ceil(wide * low_percent / 100).cast("decimal(25,0)")
    hi = F.floor(wide * high_percent / 100).cast("decimal(25,0)")
    spans = (near.select("anchor_id", F.struct(F.col("positive_rank").cast("bigint").alias("id"), lo.cast("bigint").alias("lo"),
                                               hi.cast("bigint").alias("hi")).alias("w")).filter("w.lo <= w.hi")
             .groupBy("anchor_id").agg(F.sort_array(F.collect_list("w")).alias("windows")))  # at most ``positives`` each
    asked = asked.join(spans, asked["id"] == spans["anchor_id"]).drop("anchor_id")
    found = _search(index, asked, negatives, False, blocks, asks)
    return near.join(found.select("anchor_id", F.col("window_id").cast("int").alias("positive_rank"), "rank",
                                  F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score")),
                     ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")


ORACLE = """
WITH rows AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS positive_rank
  FROM scored WHERE same QUALIFY positive_rank <= 5),
negatives AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score, positive_rank::INT AS positive_rank
FROM negatives WHERE rank <= 3
"""
