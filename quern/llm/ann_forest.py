"""Nearest neighbours by a forest of hash prefixes (LSH forest), cosine.

Each tree hashes a vector to a long string of bits, the signs of random
projections, and keeps the strings sorted. A query descends in every tree
to its longest matching prefixes, which lie side by side there; then all
trees ascend together, one prefix length at a time, until together they
hold enough candidates, and those the wanted number of different ids besides
the query's, or all there are. The candidates are scored on the original vectors
in double precision.

Rows are dealt by a hash into blocks of bounded size, each with a forest of
its own; queries are dealt into blocks too, and every query block meets
every forest. A forest is asked for a share of its rows as candidates, so
recall doesn't fall as the table grows. The nearest of each forest are
merged by score. Equal vectors are one entry of a forest with its smallest
ids, as many as any answer can need; so copies of one vector, however many,
neither crowd a prefix nor get lost.

Nulls: vectors that are null, zero, or hold null or non-finite components
take no part, nor do rows without id. Vectors are compared with vectors of
their own length only. Rows that share the query's id are no candidates;
a repeated row counts once. Ties go to the smaller id. Empty tables give
empty results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.session import ship_package

TREES, BITS = 24, 32
#: Candidates a forest collects for a query: a share of its entries, and a least number.
SHARE, LEAST = 0.05, 64
#: Rows in an index block and in a query block, about.
INDEX_ROWS, QUERY_ROWS = 8192, 2048
SEED = 11


class Forest:
    """Sorted arrays of hash strings over the distinct vectors of a block."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.trees, self.bits = trees, bits
        planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * bits))
        self.planes = planes
        codes = self.codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(trees, rows) strings of bits, the first projection highest."""
        signs = (vectors @ self.planes > 0).reshape(len(vectors), self.trees, self.bits)
        weights = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        return (signs * weights).sum(axis=2, dtype=np.uint64).T.copy()

    def spans(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each tree, query and prefix length from BITS down to 0: where the matches begin and end."""
        t, q = codes.shape
        lo = np.empty((t, self.bits + 1, q), np.int64)
        hi = np.empty_like(lo)
        for i in range(t):
            for up in range(self.bits + 1):
                free = np.uint64((1 << up) - 1)
                lo[i, up] = np.searchsorted(self.sorted[i], codes[i] & ~free, "left")
                hi[i, up] = np.searchsorted(self.sorted[i], codes[i] | free, "right")
        return lo, hi

    def candidates(self, queries: np.ndarray, wanted: int, enough=lambda q, at: True):
        """For each query the entries that share its prefixes, from the first level with ``wanted`` of them,
        an entry counted once a tree, whose distinct entries are ``enough``; or all."""
        lo, hi = self.spans(self.codes(queries))
        held = (hi - lo).sum(axis=0)                       # (levels, queries), rising as prefixes get shorter
        level = np.argmax(held >= min(wanted, held[-1].min() if held.size else 0), axis=0)
        mark = np.zeros(self.order.shape[1], bool)
        for q, up in enumerate(level.tolist()):
            while True:
                parts = [self.order[i, lo[i, up, q]:hi[i, up, q]] for i in range(self.trees)]
                mark[:] = False
                for p in parts:
                    mark[p] = True
                at = np.flatnonzero(mark)
                if up == self.bits or enough(q, at):
                    break
                up += 1
            yield q, at


def _entries(ids: np.ndarray, vectors: np.ndarray, most: int):
    """Distinct vectors and, for each, its smallest ids (at most ``most``)."""
    by = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[by], vectors[by]
    new = np.ones(len(ids), bool)
    new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
    entry = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    owners = [np.unique(ids[a:b])[:most] for a, b in zip(first, [*first[1:], len(ids)])]
    return vectors[first], owners, entry


def search_block(ids, vectors, query_ids, queries, k: int, share: float, least: int, trees: int, bits: int):
    """(query_id, vec_id, score) of the nearest ``k`` in one block for each query."""
    entries, owners, _ = _entries(ids, vectors, k + 1)
    size = np.sqrt((entries * entries).sum(axis=1))
    unit = entries / size[:, None]
    forest = Forest(unit, trees, bits)
    q_size = np.sqrt((queries * queries).sum(axis=1))
    wanted = max(least, int(np.ceil(share * len(entries) * trees)))
    out = []

    def enough(q, at):
        others: set = set()
        for a in at.tolist():
            others.update(owners[a][owners[a] != query_ids[q]].tolist())
            if len(others) >= k:
                return True
        return False

    def best(q, at, score):
        found: dict = {}
        for s, v in sorted((-s, int(v)) for s, a in zip(score.tolist(), at.tolist()) for v in owners[a] if v != query_ids[q]):
            if len(found) < k:
                found.setdefault(v, -s)
        return found

    for q, at in forest.candidates(queries / q_size[:, None], wanted, enough):
        score = (entries[at] @ queries[q]) / (size[at] * q_size[q])
        near = np.ones(len(at), bool)
        if len(at) > 4 * (k + 2):  # only entries that can be among the nearest, ties kept
            near = score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]
        found = best(q, at[near], score[near])
        if len(found) < k and not near.all():  # one id has several of them
            found = best(q, at, score)
        out += [(int(query_ids[q]), v, s) for v, s in found.items()]
    return out


def search(df: DataFrame, queries: DataFrame | None = None, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           share: float = SHARE, least: int = LEAST, trees: int = TREES, bits: int = BITS) -> DataFrame:
    """query_id, rank, vec_id, score of each query's nearest ``k``.

    ``queries`` defaults to the rows of ``df`` whose id is divisible by 50.
    """
    ship_package(df.sparkSession)

    def usable(x: DataFrame) -> DataFrame:
        x = x.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        return x.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).filter(fine & F.exists("v", lambda c: c != 0))

    index = usable(df)
    asked = usable(queries if queries is not None else df.filter(F.col(id_col) % 50 == 0)).distinct()
    n_index, n_asked = df.count(), asked.count()
    blocks = max(1, -(-n_index // INDEX_ROWS))
    asks = max(1, -(-n_asked // QUERY_ROWS))
    spread = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = index.select(F.size("v").alias("dim"), spread(blocks).alias("block"), every(asks).alias("ask"), "id", "v")
    right = asked.select(F.size("v").alias("dim"), every(blocks).alias("block"), spread(asks).alias("ask"), "id", "v")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        rows = []
        if a.num_rows and b.num_rows:
            def matrix(t):
                return np.stack(t.column("v").to_numpy()).astype(np.float64)
            rows = search_block(a.column("id").to_numpy(), matrix(a), b.column("id").to_numpy(), matrix(b), k, share, least, trees, bits)
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])

    key = ("dim", "block", "ask")
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
