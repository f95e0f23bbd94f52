"""Near-duplicates by min-max hashing.

Every document's set of distinct five-word shingles is hashed under 60
permutations; both the least and the largest value under each permutation
are kept, so 60 evaluations a shingle give a signature of 120 values.
Bands of five values (minima with minima, maxima with maxima) make 24
bucket keys: a pair at the least similarity, 0.85, shares none of them
with probability (1 - 0.85**5)**24 < 1e-6.

Equal sets are one class. Within a bucket every class is first compared
with two hubs (its least and its largest class), never with all others:
copies and most near copies link there. After the components of these
links are known, classes of one bucket that still lie in different
components are compared with each other, so no link that changes a
component is lost, and a group of thousands that holds together costs
two comparisons a member. Every link is confirmed on full shingle sets.

Nulls and ties: null or empty text, or text without words, has no shingle
and links with nothing. Rows that share a doc_id are one document. Rows
without doc_id are identified by their text, come after all ids, and
component_id is null where no id is reachable. Empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import BLANK_WORD, LOWER, Words, free_name, gram_hash, map_arrow, mix64, pieces_of, shared_table
from quern.llm.components import components

K = 5
PERMUTATIONS = 60
ROWS = 5
LEAST_PERCENT = 85
#: Shares in which the classes of a shingle are counted, and bits of a class's signature.
SALTS, BITS = 16, 512
#: Node numbers of rows without doc_id start here, above all ids.
NO_ID = 1 << 62

_rng = np.random.default_rng(20240607)
_A = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, PERMUTATIONS, np.uint64)


def shingle_sets(texts: list[str | None], k: int = K) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    w = Words([(t or "").encode("utf-8", "replace").translate(LOWER) for t in texts], BLANK_WORD)
    grams = gram_hash(w.hash, k)
    out = []
    for lo, n in zip(w.first[:-1].tolist(), w.count.tolist()):
        if n >= k:
            out.append(np.unique(grams[lo:lo + n - k + 1]))
        elif n:  # the whole sequence as one
            out.append(mix64(gram_hash(w.hash[lo:lo + n], n) + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of each run of ``flat`` under every permutation."""
    sig = np.empty((len(begins), 2 * PERMUTATIONS), np.uint64)
    for j in range(PERMUTATIONS):
        v = flat * _A[j] + _B[j]
        sig[:, j] = np.minimum.reduceat(v, begins)
        sig[:, PERMUTATIONS + j] = np.maximum.reduceat(v, begins)
    return sig


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    n_bands = sig.shape[1] // ROWS
    v = sig[:, :n_bands * ROWS].reshape(len(sig), n_bands, ROWS)
    h = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), (len(sig), n_bands)).copy()
    for i in range(ROWS):
        h = mix64(h ^ v[:, :, i])
    return h.view(np.int64)


FEATURES = "doc_id bigint, node bigint, a bigint, b bigint, n_shingles bigint, bands array<bigint>"


def _features():
    def step(b: pa.RecordBatch):
        texts = b.column("text").to_pylist()
        for lo, hi in pieces_of(np.array([len(t or "") + 1 for t in texts]), 4_000_000):
            sets = shingle_sets(texts[lo:hi])
            n = np.array([len(s) for s in sets])
            some = np.flatnonzero(n)
            a, c = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
            bands: list = [None] * (hi - lo)
            if len(some):
                flat = np.concatenate([sets[i] for i in some])
                begins = np.concatenate(([0], np.cumsum(n[some])[:-1]))
                a[some] = np.add.reduceat(mix64(flat), begins)
                c[some] = np.add.reduceat(mix64(flat ^ np.uint64(0x5DEECE66D)), begins)
                for i, key in zip(some.tolist(), bucket_keys(signatures(flat, begins))):
                    bands[i] = key
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")[lo:hi], b.column("node")[lo:hi], pa.array(a.view(np.int64)), pa.array(c.view(np.int64)),
                 pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "node", "a", "b", "n_shingles", "bands"])
    return step


def node_of(id_col: Column, text_col: Column) -> Column:
    no_id = F.xxhash64(F.coalesce(text_col, F.lit(""))).bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID))
    return F.coalesce(id_col.cast("bigint"), no_id)


def _verify(percent: int):
    def make():
        last: dict = {}

        def step(b: pa.RecordBatch):
            u, v = b.column("u").to_pylist(), b.column("v").to_pylist()
            tu, tv = b.column("text_u").to_pylist(), b.column("text_v").to_pylist()
            yes = []
            for lo, hi in pieces_of(np.array([len(x or "") + 1 for x in tu]), 2_000_000):
                sets = shingle_sets(tu[lo:hi])
                for i in range(lo, hi):
                    if v[i] not in last:  # rows come sorted by v
                        last.clear()
                        last[v[i]] = shingle_sets([tv[i]])[0]
                    s, t = sets[i - lo], last[v[i]]
                    if min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)) and len(s):
                        both = len(np.intersect1d(s, t, assume_unique=True))
                        if 100 * both >= percent * (len(s) + len(t) - both):
                            yes.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([u[i] for i in yes], pa.int64()),
                                              pa.array([v[i] for i in yes], pa.int64())], names=["u", "v"])
        return step
    return make


def _links(pairs: DataFrame, texts: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough."""
    x = (pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
         .join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v"))
    return shared_table(map_arrow(x.select("u", "v", "text_u", "text_v"), _verify(percent), "u bigint, v bigint").distinct(), name)


def _grams(b: pa.RecordBatch):
    """Every shingle of each text, and with its first one the bits that its shingles set."""
    node, texts = b.column("node").to_numpy(), b.column("text").to_pylist()
    for lo, hi in pieces_of(np.array([len(t or "") + 1 for t in texts]), 4_000_000):
        sets = shingle_sets(texts[lo:hi])
        n = np.array([len(x) for x in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(hi - lo), n)
        bits = np.zeros((hi - lo, BITS), np.uint8)
        bits[owner, (flat >> np.uint64(20)) & np.uint64(BITS - 1)] = 1
        words = np.packbits(bits, axis=1, bitorder="little").view("<i8")
        first = np.diff(owner, prepend=-1) > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[lo:hi][owner]), pa.array(flat.view(np.int64)),
             pa.array([words[o] if f else None for o, f in zip(owner.tolist(), first.tolist())], pa.list_(pa.int64()))],
            names=["cls", "gram", "bits"])


def _by_rarity(grams: DataFrame) -> DataFrame:
    """``grams`` (cls, gram) with ``held``, how many classes hold it, and ``i``, its place in its class, least held first.

    Counts are made in salted shares and handed back by share, so that a gram of many classes isn't one task.
    """
    x = grams.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int"))
    share = x.groupBy("gram", "salt").agg(F.count("*").alias("c"))
    held = share.select("gram", "salt").join(share.groupBy("gram").agg(F.sum("c").alias("held")), "gram")
    w = Window.partitionBy("cls").orderBy("held", "gram")  # one text's grams
    return x.join(held, ["gram", "salt"]).select(
        "cls", "gram", "held", (F.row_number().over(w) - 1).alias("i"))


def _open_pairs(open_: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of classes in different components that could still be similar.

    An exact prefix filter: every class's shingles stand in one order for the
    whole table, those that few open classes hold first. Two sets that are
    similar enough share a shingle among their first few, so only these are
    joined: of the larger set as many as any smaller partner leaves, of the
    smaller the fewer that a partner of its size or more leaves. A match
    counts only if it can be the pair's first shared shingle: what follows it
    must leave room for the whole overlap; and the bits that only one of the
    two sets has must not be more than what may tell them apart. Loose copies
    of one text have shingles of their own first, or bits apart, so a large
    group of them makes few pairs of its common shingles.
    """
    some = open_.select("cls", "n", "root").distinct()
    grams = shared_table(map_arrow(texts.join(some, texts["node"] == some["cls"]).select("node", "text"),
                                   lambda: _grams, "cls bigint, gram bigint, bits array<bigint>"), "grams")
    some = some.join(grams.where("bits IS NOT NULL").select("cls", "bits"), "cls")
    # The least overlap: 100 k >= percent * (union), with a smaller partner, and with one of its own size.
    probe = f"n - ceil({percent} * n / 100) + 1"
    index = f"n - ceil({2 * percent} * n / {100 + percent}) + 1"
    x = _by_rarity(grams.select("cls", "gram")).where("held > 1").join(some, "cls").where(f"i < {probe}")  # what one class holds alone meets none
    x = shared_table(x.select("gram", "cls", "n", "root", "i", "bits", F.expr(f"i < {index}").alias("first")), "prefixes")
    big, small = (x.where(c).select(F.col("gram").alias(f"gram_{s}"), *[F.col(k).alias(f"{k}_{s}") for k in ("cls", "n", "root", "i", "bits")])
                  for c, s in (("true", "u"), ("first", "v")))
    # Bits that only one of the two has are of shingles that only it has.
    apart = " + ".join(f"bit_count(bits_u[{i}] ^ bits_v[{i}])" for i in range(BITS // 64))
    met = big.join(small, F.expr(
        "gram_u = gram_v AND root_u <> root_v AND (n_u > n_v OR (n_u = n_v AND cls_u > cls_v)) "
        f"AND 100 * n_v >= {percent} * n_u AND {100 + percent} * least(n_u - i_u, n_v - i_v) >= {percent} * (n_u + n_v) "
        f"AND {100 + percent} * (n_u + n_v - ({apart})) >= {2 * percent} * (n_u + n_v)"))
    return met.select(F.greatest("cls_u", "cls_v").alias("u"), F.least("cls_u", "cls_v").alias("v")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = LEAST_PERCENT) -> DataFrame:
    """One row per row of ``df``: doc_id, node, n_shingles, component_id, kept."""
    d = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.withColumn("node", node_of(F.col("doc_id"), F.col("text")))
    rows = shared_table(map_arrow(d.select("doc_id", "node", "text"), _features, FEATURES), "minmax")
    some = rows.filter("n_shingles > 0")
    # Equal sets: one class, named by its least node.
    classes = some.groupBy("a", "b").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most")
    classes = shared_table(classes.select("a", "b", "least"), "classes")
    named = some.join(classes, ["a", "b"], "left").withColumn("cls", F.coalesce("least", "node")).drop("least")
    member = shared_table(named.select(F.col("node"), "cls").filter("node <> cls").distinct(), "members")
    leaders = named.filter("node = cls").select("cls", F.col("n_shingles").alias("n"), "bands").dropDuplicates(["cls"])
    in_bucket = leaders.select(F.explode("bands").alias("key"), "cls", "n")
    hubs = in_bucket.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo <> hi")
    crowded = shared_table(in_bucket.join(hubs, "key"), "buckets")
    pairs = (crowded.select("cls", F.explode(F.array("lo", "hi")).alias("hub")).filter("cls <> hub")
             .select(F.greatest("cls", "hub").alias("u"), F.least("cls", "hub").alias("v")).distinct())
    near = crowded.select("cls").distinct()
    texts = shared_table(d.join(near, d["node"] == near["cls"]).select("node", "text").dropDuplicates(["node"]), "near-texts")
    first = _links(pairs, texts, percent, "hub-links")
    by_hubs = components(first)
    # Classes of one bucket that lie in different components so far.
    placed = crowded.join(by_hubs.withColumnRenamed("node", "cls"), "cls", "left").select(
        "key", "cls", "n", "lo", "hi", F.coalesce("root", "cls").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("key")
    open_ = shared_table(placed.join(mixed, "key"), "open")
    rest = _open_pairs(open_, texts, percent)
    second = _links(rest.distinct(), texts, percent, "open-links")
    links = first.union(second).union(member.select(F.col("node").alias("u"), F.col("cls").alias("v")))
    root = components(links)
    out = rows.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return out.select("doc_id", "node", "n_shingles",
                      F.when(F.col("root") < NO_ID, F.col("root")).alias("component_id"),
                      (F.col("node") == F.col("root")).alias("kept"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LEAST_PERCENT) -> DataFrame:
    """Whole rows of ``df`` that stay: one document of each component."""
    name = free_name(df, "_node")
    stay = near_duplicates(df, id_col, text_col, percent).filter("kept").select(F.col("node").alias(name)).distinct()
    return df.join(stay, node_of(df[id_col], df[text_col]) == stay[name], "left_semi")
