"""Scalar rules (C1–C13, C17–C21) on literal rows, including the quirks."""

from pyspark.sql import functions as F

from quern.functions import dates as Dt
from quern.functions import errors as E
from quern.functions import lang as L
from quern.functions import quality as Q
from quern.functions import relevance as R
from quern.functions import text as T
from quern.functions import url as U


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_normalize_url_cases(spark):
    cases = {
        "https://news.google.com/rss/articles/CBMiAbC?oc=5": "google_news_CBMiAbC",
        "https://X.com/A/?utm_source=a&b=1#f": "https://x.com/a/?b=1",
        "https://x.com/a/?utm_source=a": "https://x.com/a",
        "https://x.com/?a=1&b=2&a=3&c=": "https://x.com/?a=1&a=3&b=2",
        "https://x.com/p?q=a+b&r=%7E*": "https://x.com/p?q=a+b&r=~%2a",
    }
    for raw, want in cases.items():
        assert one(spark, U.normalize_url(F.col("x")), raw) == want, raw


def test_domains_and_path_similarity(spark):
    assert one(spark, U.extract_domain(F.col("x")), "https://WWW.News.Example.co.in:8080/a") == "news.example.co.in:8080"
    assert one(spark, U.extract_main_domain(F.col("x")), "a.co.in") == "co.in"
    df = spark.createDataFrame([("https://x.com/a/b/c", "https://x.com/a/b/d")], "a string, b string")
    assert abs(df.select(U.path_similarity("a", "b")).first()[0] - 3 / 4) < 1e-12


def test_url_predicates(spark):
    long_google = "https://news.google.com/rss/articles/CBMi" + "a" * 120
    assert one(spark, U.is_problematic_url(F.col("x")), long_google) is True
    assert one(spark, U.is_problematic_url(F.col("x")), "https://FACEBOOK.com/x") is False  # case-sensitive
    assert one(spark, U.should_skip_url(F.col("x")), "https://FACEBOOK.com/x") is True
    assert one(spark, U.should_skip_url(F.col("x")), "https://linkedin.com/x") is False
    assert one(spark, U.valid_link(F.col("x")), "\t https://a.b \n") is True


def test_date_from_url_cases(spark):
    cases = {"https://a/2024/3/5/x": "2024-03-05", "https://a/x-101744080008859.html": None,
             "https://a/2024/02/30/": None, "https://a/article20240101": "2024-01-01",
             "https://a/15-03-2024/": "2024-03-15", "https://a/5_3_2024": "2024-03-05"}
    for raw, want in cases.items():
        got = one(spark, Dt.date_from_url(F.col("x")), raw)
        assert (str(got) if got else None) == want, raw


def test_gmt_to_ist_and_parse(spark):
    assert one(spark, Dt.gmt_to_ist(F.col("x")), "Tue, 05 Mar 2024 20:00:00 GMT") == "2024-03-06 01:30:00"
    assert one(spark, Dt.gmt_to_ist(F.col("x")), "not a date") == "not a date"
    for s, want in [("5/3/2024", "2024-05-03"), ("March 5, 2024", "2024-03-05"), ("2024-003-5", None),
                    ("• 5 Mar 2024 •", "2024-03-05"), ("13/3/2024", "2024-03-13")]:
        got = one(spark, Dt.parse_date_any(F.col("x")), s)
        assert (str(got) if got else None) == want, s
    rel = Dt.parse_relative_date(F.col("x"), "2024-03-10")
    assert str(one(spark, rel, "1 day ago")) == "2024-03-09"
    assert str(one(spark, rel, "21 days ago")) == "2024-03-09"   # quirk: contains '1 day'
    assert str(one(spark, rel, "10 days ago")) == "2024-03-10"   # quirk: contains '0 day'
    assert one(spark, rel, "yesterday") is None                   # no 'ago'


def test_title_key_and_fingerprint(spark):
    assert one(spark, T.title_key(F.col("x")), "The Heavy Rains flood the City of Mumbai today") == \
        "city flood heavy mumbai rains"
    # Python \w excludes combining marks: Indic words split into single letters (len ≤ 3)
    assert one(spark, T.title_key(F.col("x")), "भारी बारिश") == ""
    assert one(spark, T.content_fingerprint(F.col("x")), "short") is None
    a = one(spark, T.content_fingerprint(F.col("x")), "Word  " * 40)
    b = one(spark, T.content_fingerprint(F.col("x")), "word\t" * 40)
    assert a == b and a is not None


def test_quality_grade(spark):
    # 40 lines of distinct words: long, many paragraphs, high word variety
    high = "".join(" ".join(f"w{i}x{j}" for j in range(8)) + "\n" for i in range(40))
    assert one(spark, Q.quality_grade(F.col("x")), high) == "high"
    assert one(spark, Q.quality_grade(F.col("x")), high + "<b>x</b>") == "medium"
    assert one(spark, Q.quality_grade(F.col("x")), "") == "low"
    assert one(spark, Q.quality_grade(F.col("x")), ("same " * 400 + "\n") * 3) == "low"


def test_script_language(spark):
    hindi = "भारी बारिश से शहर में बाढ़ आई और लोग परेशान हुए " * 3
    assert one(spark, L.script_language_first(F.col("x")), hindi) == "hi"
    assert one(spark, L.script_language_dominant(F.col("x")), hindi) == "hi"
    assert one(spark, L.script_language_first(F.col("x")), "short") == "en"
    tamil_mixed = "கனமழை " * 5 + "english words here to pad the text a bit more"
    assert one(spark, L.script_language_dominant(F.col("x")), tamil_mixed) == "ta"
    assert one(spark, L.language_code(F.col("x")), "Tamil, English") == "en"  # english tested first
    assert one(spark, L.language_code(F.col("x")), "Mizo") == "en"
    assert one(spark, L.primary_language(F.col("x")), "unknown-place") == "en"
    assert one(spark, L.region_display(F.col("x")), "west-bengal") == "West Bengal"


def test_relevance_branches(spark):
    terms = ["flood", "flash flood", "rain"]
    assert one(spark, R.is_relevant(F.col("x"), terms), "flash flood hits town") is True   # overlap counts 2
    assert one(spark, R.is_relevant(F.col("x"), terms), "flood in the area") is True       # 1 + context
    assert one(spark, R.is_relevant(F.col("x"), terms), "flood of memes") is False
    assert one(spark, R.is_relevant(F.col("x"), terms),
               "rain and flood: cricket, football and film news") is False                 # 3 irrelevant
    assert one(spark, R.is_relevant(F.col("x"), []), "flood") is False


def test_error_classes(spark):
    assert one(spark, E.classify_error(F.col("x")), "Max retries exceeded") == "rate_limit"
    assert one(spark, E.classify_error(F.col("x")), "SSLError EOF") == "ssl_error"
    assert one(spark, E.classify_error(F.col("x")), "weird") == "unknown_error"
    assert one(spark, E.is_fatal_error(F.col("x")), "403 Forbidden") is True
    assert one(spark, E.is_fatal_error(F.col("x")), "FORBIDDEN") is False


def test_ist_shift_ignores_the_session_zone(spark):
    """A wall clock inside a zone's missing hour is shifted by 5:30 like any other."""
    from quern.functions import dates as Dt
    from pyspark.sql import functions as F
    rows = ["Sun, 10 Mar 2024 02:30:00 GMT", "Tue, 05 Mar 2024 20:00:00 GMT", "Sun,  3 Nov 2024 01:30:00 UTC", "Thu, 31 Feb 2024 01:00:00 GMT", "x"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in spark.createDataFrame([(r,) for r in rows], "p string").select(Dt.gmt_to_ist(F.col("p"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-10 08:00:00", "2024-03-06 01:30:00", "2024-11-03 07:00:00", rows[3], "x"]


def test_one_reading_finds_what_instr_finds(spark):
    """Terms inside terms, repeats, signs, other scripts, nulls; every rule as one phrase at a time."""
    from quern.operators import patterns
    lists = {"en": ["he", "she", "hers", "her", "he", "x y", "", "É"], "hi": ["बाढ़", "बा"], "none": []}
    bad, good = ["film", "fil", "lm", "i"], ["city", "it"]
    texts = ["ushers", "HERS and the Film", "x  y x y", "", None, "बाढ़ city", "é", "fil lm it", "nothing fits", "she film"]
    rows = [(i, lang, t) for i, (lang, t) in enumerate((lang, t) for lang in ("en", "hi", "none", "zz", None) for t in texts)]
    df = spark.createDataFrame(rows, "id int, lang string, text string").repartition(3)
    got = {r["id"]: r for r in patterns.relevance_by_list(df, lists, irrelevant=bad, context=good).collect()}
    for lang, terms in [*lists.items(), ("zz", lists["en"]), (None, lists["en"])]:
        part = df.where(F.col("lang").eqNullSafe(F.lit(lang)))
        want = part.select("id", R.term_hits("text", terms).alias("hits"), R.is_relevant("text", terms, bad, good).alias("relevant"),
                           R.relevance_reason("text", terms, bad, good).alias("reason")).collect()
        assert want
        for w in want:
            g = got[w["id"]]
            assert (g["hits"], g["relevant"], g["reason"]) == (w["hits"], w["relevant"], w["reason"]), (lang, w, g)
