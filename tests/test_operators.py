"""Operators against brute-force models on small fixtures."""

import random

from pyspark.sql import functions as F

from quern.dims import languages as dims
from quern.operators import dedup as D
from quern.operators import joins
from quern.operators import ranking as RK

RANK = {"high": 3, "medium": 2, "low": 1}


def loop_url_stage(rows, faithful):
    """Row-by-row model of stage 1 (keyed by url, grade order high>medium>low)."""
    best, out = {}, []
    for r in rows:
        k = r["url"]
        if not k:
            out.append(r)
            continue
        if k not in best:
            best[k] = r
            out.append(r)
        elif RANK[r["q"]] > RANK[best[k]["q"]]:
            if not faithful:
                out = [x for x in out if x is not best[k]]
            best[k] = r
            out.append(r)
    return out


def test_url_stage_matches_loop_model(spark):
    rnd = random.Random(7)
    rows = [{"seq": i, "url": rnd.choice(["", "a", "b", "c", "d"]), "q": rnd.choice(list(RANK))}
            for i in range(400)]
    df = spark.createDataFrame([(r["seq"], r["url"], RANK[r["q"]]) for r in rows], "seq long, url string, q int")
    for faithful in (False, True):
        want = sorted(r["seq"] for r in loop_url_stage(rows, faithful))
        got_df = (D.keep_faithful(df, "url", "q", "n") if faithful
                  else D.keep_best(df, "url", [-F.col("q")], "n"))
        assert sorted(r.seq for r in got_df.select("seq").collect()) == want


def test_keep_best_counts_and_passthrough(spark):
    df = spark.createDataFrame([(1, "k", 1), (2, "k", 3), (3, None, 1), (4, "k", 3)], "seq long, key string, q int")
    out = {r.seq: r.n for r in D.keep_best(df, "key", [-F.col("q")], "n").collect()}
    assert out == {2: 3, 3: 1}


def test_running_sum_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), i, rnd.randint(0, 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {r.o: r.s for r in RK.running_sum(df, "g", "o", "v", "s", width=16).collect()}
    acc = {}
    for g, o, v in rows:
        acc[g] = acc.get(g, 0) + v
        assert got[o] == acc[g]
    ranks = {r.o: r.r for r in RK.rank_in_group(df, "g", "o", "r", width=7).collect()}
    seen = {}
    for g, o, _ in rows:
        assert ranks[o] == seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1



def test_parse_page_fields():
    from quern.operators.pages import parse_page
    html = ("<html><head><title>Floods hit the city | The Hindu</title>"
            "<meta name='description' content='short'></head><body><h1>Hi</h1>"
            "<div class='news-list'><a href='/article/1'>Flood news</a></div>"
            "<article><p>First paragraph of the article that is long enough to count.</p>"
            "<p>Second one &amp; more text</p></article><script>var x='<p>';</script></body></html>")
    r = parse_page(1, "https://x.example.com/a", html, ["flood"])
    assert r["title"] == "Floods hit the city | The Hindu"
    assert r["h1s"] == ["Hi"]
    assert r["ps"][1] == "Second one & more text"
    assert r["anchors"][0]["in_section"] and r["anchors"][0]["parent_hit"]
    assert r["containers"][0]["sel"] == 0 and r["containers"][0]["n_p"] == 2


def test_page_title_cascade(spark):
    from quern.operators import pages as P
    pg = spark.createDataFrame([
        (1, "https://a/x", "<title>Floods hit the city | The Hindu</title><h1>Hi</h1>"),
        (2, "https://a/y", "<h1>A proper headline here</h1>"),
        (3, "https://a/z", "<meta property='og:title' content=' OG title '>")], "page_id long, url string, html string")
    p = P.parse_pages(pg)
    got = {r.page_id: r.t for r in p.select("page_id", P.page_title(p).alias("t")).collect()}
    assert got == {1: "Floods hit the city", 2: "A proper headline here", 3: "OG title"}


def test_region_selection(spark):
    import pytest
    from quern.operators.filters import region_selection
    df = spark.createDataFrame([("assam",), ("delhi",)], "region string")
    assert region_selection(df, None).count() == 2
    assert [r.region for r in region_selection(df, "delhi").collect()] == ["delhi"]
    with pytest.raises(ValueError):
        region_selection(df, "atlantis")


def test_linkage_key_is_csv_and_place(spark):
    """``seq`` restarts in each CSV; rows of different CSVs never mix."""
    from quern.operators.joins import enrich_metadata, link_final_to_original
    links = spark.createDataFrame([("a", 1, "https://x.com/p", "ta"), ("b", 1, "https://x.com/p", "tb"), ("b", 2, "https://y.com/q", "tq")],
                                  "csv string, seq int, Link string, Title string")
    links = links.selectExpr("*", "'' AS Source", "'' AS Summary", "'' AS Date", "'' AS Term", "'' AS LanguageQueried")
    finals = spark.createDataFrame([("a", 1, "https://o.com/1", "https://x.com/p"), ("b", 1, "https://o.com/2", "https://y.com/q/more"),
                                    ("b", 2, "https://o.com/3", "https://z.net/")], "csv string, seq int, original_url string, final_url string")
    m = link_final_to_original(finals, links, "csv")
    got = {(r.csv, r.seq): (r.matched_link, r.match_tier) for r in m.collect()}
    assert got == {("a", 1): ("https://x.com/p", 1), ("b", 1): ("https://y.com/q", 3), ("b", 2): ("https://o.com/3", 0)}
    titles = {(r.csv, r.seq): r.title for r in enrich_metadata(
        m.selectExpr("*", "'own' AS page_title"), links, "csv", extracted_title="page_title").collect()}
    assert titles == {("a", 1): "ta", ("b", 1): "tq", ("b", 2): "own"}


def test_linkage_with_a_common_path_segment(spark):
    """A host whose links all share a segment: every final still finds its best link."""
    from quern.operators.joins import link_final_to_original
    n = 60
    links = spark.createDataFrame([("c", i, f"https://h.com/news/a{i}/b{i}") for i in range(n)], "csv string, seq int, Link string")
    finals = spark.createDataFrame([("c", i, "https://o.org/x", f"https://h.com/news/a{i}/other") for i in range(n)],
                                   "csv string, seq int, original_url string, final_url string")
    got = {r.seq: (r.matched_link, r.match_tier) for r in link_final_to_original(finals, links, "csv").collect()}
    assert got == {i: (f"https://h.com/news/a{i}/b{i}", 3) for i in range(n)}


def test_regional_terms_match_their_scripts(spark):
    from quern.dims import languages as dims
    from quern.functions.relevance import term_hits
    from quern.operators.joins import relevance_by_language
    rows = [("hi", "कल भारी बारिश और बाढ़"), ("ta", "நேற்று கனமழை வெள்ளம்"), ("bn", "আজ বন্যা ও ঘূর্ণিঝড়"), ("xx", "A Flood and storm")]
    df = relevance_by_language(spark.createDataFrame(rows, "lang string, text string"), dims.terms_frame(spark))
    got = {r.lang: r.hits for r in df.select("lang", term_hits("text", df["terms"]).alias("hits")).collect()}
    assert got == {"hi": ["भारी बारिश", "बाढ़"], "ta": ["கனமழை", "வெள்ளம்"], "bn": ["বন্যা", "ঘূর্ণিঝড়", "ঝড়"], "xx": ["flood", "storm"]}


def test_banned_patterns_follow_the_streak(spark):
    """All attempts failed and the run of failures at the end is three or more."""
    import datetime as dt
    from pyspark.sql import functions as F
    from quern.operators.requests import banned_patterns
    t0 = dt.datetime(2024, 1, 1)
    log, n = [], 0
    for key, searches in {1: [[1, 0], [0, 0], [0, 0]], 2: [[0, 0]], 3: [[0], [0, 0]], 4: [[0, 0], [0]]}.items():
        for s, tries in enumerate(searches):
            for ok in tries:
                log.append((n, t0 + dt.timedelta(minutes=n), key, s, bool(ok)))
                n += 1
    df = spark.createDataFrame(log, "event_id long, ts timestamp, key long, search_id long, success boolean")
    got = {(r.key, r.search_id) for r in banned_patterns(df, F.lit("en"), attempts=2).collect()}
    assert got == {(1, 1), (1, 2), (3, 1)}


# --- keyword lists (C18, E5) ----------------------------------------------

def test_unknown_languages_take_the_english_list_of_the_passed_table(spark):
    rows = spark.createDataFrame([(1, "es"), (2, "hi"), (3, None), (4, "en")], "id int, lang string")
    own = spark.createDataFrame([("en", 1, "second"), ("en", 0, "first"), ("hi", 0, "x")], "lang string, ord int, term string")
    got = {r["id"]: r["terms"] for r in joins.relevance_by_language(rows, own).collect()}
    assert got == {1: ["first", "second"], 2: ["x"], 3: ["first", "second"], 4: ["first", "second"]}
    without = joins.relevance_by_language(rows, own.where("lang = 'hi'")).collect()
    assert {r["id"]: r["terms"][:2] for r in without} == {1: ["monsoon", "heavy rain"], 2: ["x"], 3: ["monsoon", "heavy rain"], 4: ["monsoon", "heavy rain"]}


def test_texts_of_every_regional_language_meet_their_own_list(spark):
    """One phrase of each list, written out here."""
    texts = [("hi", "कल भारी बारिश हुई"), ("ta", "இன்று கனமழை"), ("te", "నేడు భారీ వర్షం"), ("bn", "আজ ভারী বৃষ্টি"),
             ("gu", "આજે ભારે વરસાદ"), ("mr", "आज मुसळधार पाऊस"), ("ml", "ഇന്ന് കനത്ത മഴ"), ("kn", "ಇಂದು ಭಾರೀ ಮಳೆ"),
             ("pa", "ਅੱਜ ਭਾਰੀ ਮੀਂਹ"), ("or", "ଆଜି ଭାରି ବର୍ଷା"), ("as", "আজি ভাৰী বৰষুণ"), ("ne", "आज भारी वर्षा"),
             ("mni", "ꯉꯁꯤ ꯅꯨꯡꯁꯤꯠ"), ("lus", "vawiin ruahtui nasa")]
    from quern.functions.relevance import term_hits
    df = joins.relevance_by_language(spark.createDataFrame(texts, "lang string, text string"), dims.terms_frame(spark))
    got = {r["lang"]: r["h"] for r in df.select("lang", term_hits("text", F.col("terms")).alias("h")).collect()}
    assert len(got) == 14 and all(got.values())
    assert got["ml"] == ["കനത്ത മഴ"] and got["lus"] == ["ruahtui", "ruahtui nasa"] and got["or"] == ["ବର୍ଷା", "ଭାରି ବର୍ଷା"]
    assert dims.REGIONAL_TERMS["kn"].count("ಚಂಡಮಾರುತ") == 2 and sum(map(len, dims.REGIONAL_TERMS.values())) == 343 - 31


def test_every_region_has_its_languages_terms(spark):
    pairs = dims.region_languages_frame(spark)
    got = joins.region_language_terms(pairs.select("region").distinct(), dims.terms_frame(spark))
    n = {(r["region"], r["lang"]): r["n"] for r in got.groupBy("region", "lang").agg(F.count("*").alias("n")).collect()}
    assert len(n) == 102
    assert all(k == len(dims.REGIONAL_TERMS.get(lang, dims.ENGLISH_TERMS)) for (_, lang), k in n.items())


def test_parsed_pages_leave_in_small_batches(spark):
    """A worker holds the rows of about BATCH_CHARS characters, whatever the batch; ids and nulls come through."""
    import pyarrow as pa
    from quern.operators import pages as P
    html = "<h1>A heading of the page</h1><p>" + "flood " * 30_000 + "</p>"
    rows = [(2**60 + i, f"https://x.example.com/{i}", html) for i in range(20)] + [(None, None, None)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["page_id", "url", "html"])
    out = list(P.parsed_batches(batch, ["flood"]))
    assert len(out) > 2 and max(b.num_rows for b in out) * len(html) < P.BATCH_CHARS + len(html)
    assert [i for b in out for i in b.column("page_id").to_pylist()] == [r[0] for r in rows]
    pages = spark.createDataFrame([(1, "https://x.example.com/", "<meta name='date' content='2024-01-02'><a href='/flood'>flood</a>"),
                                   (None, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r for r in P.parse_pages(pages, ["flood"]).collect()}
    assert got[1].metas == {"name:date": "2024-01-02"} and got[1].anchors[0].href == "/flood"
    assert got[None].url is None and got[None].h1s == [] and got[None].title is None
