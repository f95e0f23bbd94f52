"""Language, mixing, licences, search and URLs against brute force, and their edge cases."""

import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from quern.llm import ann_forest as A
from quern.llm import langid as L
from quern.llm import license_scan as X
from quern.llm import mixing as M
from quern.llm import queries as Q
from quern.llm import url_trees as U
from quern.llm.common import table

from conftest import SF

SF01 = "/root/testdata/sf0.01"


# --- language -----------------------------------------------------------

def test_marginals_equal_the_plain_recursion():
    rng = np.random.default_rng(1)
    model = L.Model(["a", "b", "c"], None, None, None, rng.normal(size=(3, 3)), rng.normal(size=3))
    count = np.array([1, 0, 7, 200, 33])
    e = rng.normal(size=(count.sum(), 3)) * 2
    got, at = L.marginals(e, count, model), 0
    step, first = np.exp(model.step), np.exp(model.first)
    for n in count:
        x = np.exp(e[at:at + n])
        a, b = np.zeros_like(x), np.ones_like(x)
        for i in range(n):
            a[i] = (a[i - 1] @ step if i else first) * x[i]
            a[i] /= a[i].sum()
        for i in range(n - 2, -1, -1):
            b[i] = step @ (x[i + 1] * b[i + 1])
            b[i] /= b[i].sum()
        p = a * b / (a * b).sum(axis=1, keepdims=True)
        assert np.allclose(p, got[at:at + n], atol=1e-9)
        at += n


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF01, "documents")
    got = Q.op1_crf_langid(spark, SF01).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000 and all(0 <= x.score <= 1 for x in got)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    held = [x for x in got if x.held_out]
    assert sum(x.lang_pred == x.lang for x in held) / len(held) > 0.97


def test_language_switches_inside_a_text(spark):
    docs = table(spark, SF01, "documents")
    model = L.fit(docs)
    long = {l: docs.filter((F.col("lang") == l) & (F.length("text") > 2000)).orderBy("doc_id").first().text for l in ("de", "fr")}
    words = {l: re.findall(r"[^\W\d_]+", t)[:150] for l, t in long.items()}
    mixed = spark.createDataFrame([(1, " ".join(words["de"] + words["fr"]))], "doc_id bigint, text string")
    runs = L.predict(mixed, model, runs=True).first().runs
    at = {x.lang: x for x in sorted(runs, key=lambda x: x.words)}
    assert sum(x.words for x in runs) == 300
    share = sum(max(0, min(x.first + x.words, 150) - x.first) for x in runs if x.lang == "de") / 150
    assert share > 0.8 and "fr" in at


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 34 !", "de"), (4, "the and of", None), (None, "the", "en"), (4, "the and of", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    none = {x.doc_id: (x.lang_pred, x.score) for x in L.predict(df, None).collect()}
    assert none[1] == none[4] == ("und", 0.0)
    model = L.train([("en", "the and of with that"), ("de", "der und die das nicht"), ("fr", ""), ("es", "123")])
    assert model.labels == ["de", "en"]
    got = {x.doc_id: x.lang_pred for x in L.predict(df, model).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] == got[None] == "en"
    assert L.train([]) is None and L.fit(df.limit(0)) is None
    assert L.predict(df.limit(0), model).count() == 0


def test_language_of_long_texts_only_is_learned(spark):
    """A language is learned from pieces of its long texts where its shorter ones don't fill the sample."""
    rng = random.Random(4)
    words = {"en": "the and of with that from".split(), "de": "der und nicht auch noch wir".split(), "fr": "avec dans pour les une est".split()}
    text = lambda l, n: " ".join(rng.choice(words[l]) for _ in range(n))
    rows = [(i, text("en", 200), "en") for i in range(0, 40)] + [(100 + i, text("de", 12_000), "de") for i in range(8)]
    rows += [(200, "1 " * 30_000 + text("fr", 12_000), "fr"), (201, "est", "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    taken = L.sample(df)
    assert max(len(t) for _, t in taken) <= L.SAMPLE_CHARS + 8
    assert sorted(l for l, _ in taken) == ["de"] * 8 + ["en"] * 40 + ["fr"] * 2
    assert all(set(t.split()) <= set(words["de"]) and len(t) > 35_000 for l, t in taken if l == "de")
    assert max(len(t) for l, t in taken if l == "fr") > 30_000
    model = L.train(taken)
    asked = [(i, text(l, 30), l) for i, l in enumerate(["en", "de", "fr"])]
    got = {x.doc_id: x.lang_pred for x in L.predict(spark.createDataFrame(asked, "doc_id bigint, text string, lang string"), model).collect()}
    assert got == {0: "en", 1: "de", 2: "fr"}
    assert L.sample(df, 5) and {l: sum(k == l for k, _ in L.sample(df, 5)) for l in words} == {"en": 5, "de": 5, "fr": 2}


# --- mixing -------------------------------------------------------------

def plain_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] > most * sizes[s] * total}
        if not full:
            out |= {s: left * weight[s] / total for s in open_}
            break
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def check_mix(rows, got):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = plain_targets(sizes)
    taken: dict = {}
    for x in got:
        m = x.mix
        assert m.size == size(x.text) and m.source_size == sizes[x.source] and m.taken <= 3 * m.size
        assert math.isclose(m.target, want[x.source], rel_tol=1e-12, abs_tol=1e-9)
        assert all(0 <= v.position <= 1 for v in m.visits) and sum(v.words for v in m.visits) == m.taken
        taken[x.source] = taken.get(x.source, 0) + m.taken
    assert taken == {s: math.floor(t) for s, t in want.items()}


def mix_rows(seed):
    r = random.Random(seed)
    rows = [(i, " ".join(["w"] * r.randrange(0, 60)), r.choice(["hot", "hot", "hot", "b", "é", "\U0001F600", "\uFFFD", None])) for i in range(400)]
    rows += [(900, "a b c", "tiny"), (901, None, "void"), (None, "x y", "b"), (7, "same", "b"), (7, "same", "b")]
    return rows


def test_mix_equals_plain_water_filling(spark):
    for seed in (1, 2):
        rows = mix_rows(seed)
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
        got = M.assign(df).collect()
        assert len(got) == len(rows)
        check_mix(rows, got)
        again = M.assign(df.repartition(3)).collect()
        key = lambda x: str((x.doc_id, x.source, x.text, x.mix))
        assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_follows_its_schedules(spark):
    """Words of a fading source come early, those of a growing one late, as the integrals say."""
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a", "b", "c"] * 1000)]
    got = M.assign(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    half: dict = {}
    for x in got:
        for v in x.mix.visits:
            n = half.setdefault(x.source, [0, 0])
            n[v.position >= 0.5] += v.words
    early = {s: a / (a + b) for s, (a, b) in half.items()}
    assert abs(early["a"] - 0.625) < 0.01 and abs(early["b"] - 0.5) < 0.01 and abs(early["c"] - 0.3125) < 0.01


def test_curriculum_rows(spark):
    rows = mix_rows(3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    visits = sum(len(x.mix.visits) for x in M.assign(df).collect())
    out = M.curriculum(df, partitions=4)
    assert out.columns == df.columns and out.count() == visits
    assert M.assign(df.limit(0)).count() == 0
    assert M.assign(df.select("doc_id", F.lit(None).cast("string").alias("text"), "source")).filter("mix.taken <> 0").count() == 0


# --- licences -----------------------------------------------------------

PLACES = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))


def places(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for label, phrase in PLACES:
        p = phrase.split()
        hits = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_places_equal_brute_force(spark):
    mit = X.NOTICES[0].text
    texts = [None, "", "Under the MIT-License, under THE mit license!", "apache license version 2.0 cc by-nc cc by nc nc",
             "x " * 5000 + "cc by nc" + " y" * 3000, "under the mit\nLicénse", "cc by", "cc by nc " * 300, "the mit license under",
             "intro " + mit + " outro", "intro " + mit.replace("free of charge", "gratis, free of any charge") + " outro",
             "Permission is hereby granted, it says", "this program is free software"]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(2, texts[2], "z"), (None, texts[3], "z")]
    got = X.digest(X.scan(spark.createDataFrame(rows, "doc_id bigint, text string, k string").repartition(3))).collect()
    key = lambda x: (str(x[0]), x[1:])
    assert sorted(((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in got), key=lambda x: str(x)) == sorted(
        ((d, *places(t)) for d, t, _ in rows), key=lambda x: str(x))
    by = {x.doc_id: x for x in got if x.doc_id is not None}
    assert by[9].labels == "mit" and by[9].base_labels == "" and by[9].score > 0.95
    assert by[10].labels == "mit" and by[10].score < 1
    assert by[11].labels == by[12].labels == "" and by[12].score == 0
    assert X.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_license_spans_are_word_places(spark):
    text = "one two " + X.NOTICES[3].text + " three"
    s = X.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first().spans[0]
    assert (s.label, s.first, s.end) == ("bsd", 2, 2 + len(X.words_of(X.NOTICES[3].text)))


def test_license_scan_on_the_table(spark):
    got = {x.doc_id: x for x in Q.op6_license_scan(spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        x = got[r.doc_id]
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == places(r.text)


# --- search -------------------------------------------------------------

def nearest(ids, v, k):
    out = {}
    norm = np.sqrt((v * v).sum(axis=1))
    for q in np.flatnonzero(ids % 50 == 0):
        s = v @ v[q] / (norm * norm[q])
        best: dict = {}
        for i in range(len(ids)):
            if ids[i] != ids[q]:
                best[int(ids[i])] = max(best.get(int(ids[i]), -9), s[i])
        out[int(ids[q])] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_search_recall_and_scores(spark):
    rows = table(spark, SF01, "embeddings").select("vec_id", "embedding").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = nearest(ids, v, 5)
    got: dict = {}
    for x in Q.op9_prefix_forest(spark, SF01).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    assert set(got) == set(want)
    assert all([s for _, s in g] == sorted((s for _, s in g), reverse=True) for g in got.values())
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.95
    exact = {(q, a): s for q, w in want.items() for a, s in w}
    assert all(abs(s - exact[q, a]) < 1e-12 for q, g in got.items() for a, s in g if (q, a) in exact)


def test_search_edges(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 130)] + [(200, [3.0, 2.0, 1.0]), (201, None), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 2.0]),
            (250, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]), (None, same), (300, [1.0, 1.0]), (350, [2.0, 2.1]), (7, same)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("x"))
    got: dict = {}
    for x in A.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert got == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4], 200: [0, 1, 2, 3, 4], 300: [350], 350: [300]}
    assert A.search(df.limit(0)).count() == 0


def test_forest_levels_hold_what_shares_the_prefix():
    rng = np.random.default_rng(3)
    f = A.Forest(rng.normal(size=(300, 8)), trees=3, bits=10)
    codes = f.codes(rng.normal(size=(5, 8)))
    lo, hi = f.spans(codes)
    for t in range(3):
        for up in range(11):
            for q in range(5):
                want = {i for i, c in zip(f.order[t], f.sorted[t]) if int(c) >> up == int(codes[t, q]) >> up}
                assert set(f.order[t, lo[t, up, q]:hi[t, up, q]]) == want


def test_search_gives_k_rows_around_tight_groups(spark):
    """Tight neighbours, or an id with many vectors, fill the trees but not the answer."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(20, 16))
    v[1], v[2] = v[0] + 1e-9, v[0] - 1e-9
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(50, (v[0] + j * 1e-9).tolist()) for j in range(2, 12)]
    ids, every = np.array([i for i, _ in rows]), np.array([x for _, x in rows])
    got: dict = {}
    for x in A.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert set(got) == {0, 50} and all(len(g) == len(set(g)) == 5 for g in got.values())
    assert all({1, 2} <= set(g) for g in got.values())
    few = [(i, x) for i, x in rows if i in (0, 1, 50)]
    got = A.search(spark.createDataFrame(few, "vec_id bigint, embedding array<double>")).collect()
    assert {(x.query_id, x.vec_id) for x in got} == {(0, 1), (0, 50), (50, 0), (50, 1)}


# --- URLs ---------------------------------------------------------------

def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return low, re.match(r"[^?#]*", rest[len(host):], re.S).group()


def rule(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_url_rules_equal_brute_force(spark):
    urls = ["http://a.Example.ORG/es/1", "https://example.org/en/19?x=1", "http://example.org/en/2", "http://badexample.org/es/", "http://org",
            "http://org/", "x.com/de/1", None, "", "ftp://m.shop.com/de/?a=b#c", "http://b.com/fr/\nq", "http://com/fr/", "http://É.com/de/",
            "http://a.com?x=/de/", "a://b://c.org/x", "http://a.org#/es/", "http://casino-x.net/p", "://host.com/fr/é"]
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h")]
    got = U.judge(spark.createDataFrame(rows, "page_id bigint, url string, host string")).collect()
    assert len(got) == len(rows)
    for x in got:
        host, path = split(urls[x.page_id])
        r = rule(host, path)
        assert (x.host, x.path, x.rule) == (host, path, r.name if r else None)
        assert x.verdict == r.verdict if r else x.verdict in ("allow", "block")
    assert U.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_url_trees_learn_their_labels(spark):
    got = Q.op10_url_trees(spark, SF01).collect()
    assert len(got) == 250
    for x in got:
        r = rule(x.host, x.path)
        assert x.rule == (r.name if r else None) and (r is None or x.verdict == r.verdict)
    listed = [x.score > 0.5 for x in got if x.rule is None and any(w in x.host for w in U.BLOCK_WORDS)]
    assert not listed or sum(listed) / len(listed) > 0.8


def test_url_sample_holds_both_kinds(spark):
    """However rare a kind is among the labelled URLs, the trees learn it."""
    rows = [(i, f"http://site{i % 97}.org/page/{i}") for i in range(3000)] + [(5000, "http://x.casino-bets.net/a?b=1&c=2")]
    rows += [(6000 + i, f"http://y{i}.casin0-bet.net/a?b={i}&c=2") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    own = [x.score for x in U.judge(df, train_rows=200).collect() if x.rule is None]
    assert len(own) == 6 and min(own) > 0.0
    few = U.sample_sizes({0.0: 3000, 1.0: 1}, 200)
    assert few == {0.0: 199, 1.0: 1}
    assert U.sample_sizes({0.0: 150, 1.0: 50}, 200) == {0.0: 150, 1.0: 50} and U.sample_sizes({0.0: 7000}, 200) == {0.0: 200}
    assert U.sample_sizes({0.0: 10**9, 1.0: 10**9}, 20_000) == {0.0: 10_000, 1.0: 10_000}
    assert U.sample_sizes({0.0: 10**9, 1.0: 5000}, 20_000) == {0.0: 19_000, 1.0: 1000} and U.sample_sizes({}, 200) == {}
