"""Exact and near dedup against brute force, and their edge cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from quern.llm import chunk_dedup as C
from quern.llm import minmax as M
from quern.llm.components import components

SCHEMA = "doc_id bigint, text string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def classes(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def copies(seed):
    """Groups of loose copies on both sides of the threshold, and odd texts."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for size in (8, 60, 150, 150, 150):
        base = [r.choice(vocab) for _ in range(size)]
        for _ in range(50):
            w = list(base)
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(size)] = r.choice(vocab[:20])
            rows.append((len(rows), " ".join(w)))
    odd = [None, "", "a b", "a b", "A  b", "x", " \t\n", "x y z w v", "X Y z w v", "a b c d", "b a"]
    return rows + [(len(rows) + i, t) for i, t in enumerate(odd)]


def test_near_duplicates_equal_brute_force(spark):
    rows = copies(3)
    want = classes(rows)
    got = M.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)


def test_near_duplicates_edges(spark):
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [(5, long, 1), (4, long + " end", 2), (None, long, 3), (None, None, 4), (9, "p q r s t u", 5), (9, "p q r s t u", 6),
            (None, "lone words of a text without id", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node int")  # a clashing extra column
    got = M.near_duplicates(df).collect()
    by = {(x.doc_id, x.n_shingles): (x.component_id, x.kept) for x in got}
    assert len(got) == 7
    assert by[(5, 29996)] == (4, False) and by[(4, 29997)] == (4, True) and by[(None, 29996)] == (4, False)
    assert by[(None, 0)] == (None, True) and by[(9, 2)] == (9, True) and by[(None, 3)] == (None, True)
    stay = M.keep_first(df).collect()
    assert sorted(x.node for x in stay) == [2, 4, 5, 6, 7]


def test_min_max_signature_estimates_similarity():
    a = M.shingle_sets([" ".join(f"w{i}" for i in range(1000))])[0]
    b = M.shingle_sets([" ".join(f"w{i}" for i in range(60, 1060))])[0]
    import numpy as np
    sig = M.signatures(np.concatenate([a, b]), np.array([0, len(a)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.12


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def texts(seed):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdefgh nopr\nst,.é") for _ in range(n)) for n in (0, 3, 700, 5000, 40000)]
    near = [b[:len(b) // 2] + "#" + b[len(b) // 2:] for b in base]
    rows = [(i, r.choice(base + near)) for i in range(80)]
    return rows + [(80, None), (81, ""), (None, base[2]), (None, "alone"), (82, "twice"), (82, "twice")]


def check_groups(rows, got):
    group = {}
    for d, t in rows:
        group.setdefault(t or "", []).append(d)
    want = []
    for d, t in rows:
        ids = [x for x in group[t or ""] if x is not None]
        want.append((d, max(ids, default=None), len(group[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda x: (x[0] is None, x[0] or 0, str(x))
    assert sorted([(x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in got], key=key) == sorted(want, key=key)
    for t, ids in group.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        assert sum(x.kept for x in got if x.text_sha256 == sha) == 1


def test_exact_groups(spark):
    rows = texts(2)
    check_groups(rows, C.groups(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect())
    assert C.groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_clashing_identifiers_are_told_apart(spark):
    """With a name of three values almost all chunks clash, and the groups are still right."""
    rows = texts(5)
    weak = lambda c: F.struct(F.pmod(F.xxhash64(c), F.lit(3)).alias("a"))
    check_groups(rows, C.groups(spark.createDataFrame(rows, SCHEMA), ident=weak).collect())


def test_keep_last_keeps_whole_rows(spark):
    rows = [(d, t, i) for i, (d, t) in enumerate(texts(7))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept int")
    stay = C.keep_last(df)
    assert stay.columns == df.columns
    assert sorted((x.text or "") for x in stay.collect()) == sorted({t or "" for _, t, _ in rows})


def test_chunks_lose_nothing(spark):
    df = spark.createDataFrame(texts(11), SCHEMA).filter("text IS NOT NULL")
    assert df.filter(F.array_join(C.chunks(F.col("text")), "") != F.col("text")).count() == 0
    assert df.select(F.max(F.size(C.chunks(F.col("text"))))).first()[0] > 4
