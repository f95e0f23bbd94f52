"""Sources and sinks on reference-shaped fixtures written to a scratch folder."""

import json
import os
import tempfile

import pytest

from quern.sources import io

ROW = ('"Heavy rain lashes city","https://news.google.com/rss/articles/CBMiAbC?oc=5","2025-09-02 10:30:00",'
       '"Daily","<a href=""x"">Heavy rain</a> ""quoted""","Monsoon","en"\n')
HEADER = "Title,Link,Date,Source,Summary,Term,LanguageQueried\n"


def _tree():
    root = tempfile.mkdtemp(prefix="quern-links-")
    for region_type, region, day in [("states", "assam", "02"), ("states", "kerala", "03"),
                                      ("union-territories", "delhi", "02")]:
        d = os.path.join(root, region_type, region, "Monsoon", "2025", "09", day)
        os.makedirs(d)
        with open(os.path.join(d, "results.csv"), "w") as f:
            f.write(HEADER + ROW)
    return root


def test_read_links_tree(spark):
    df = io.read_links(spark, _tree())
    rows = sorted((r.region_type, r.region, str(r.run_date), r.LanguageQueried, r.Summary) for r in df.collect())
    assert rows[0] == ("states", "assam", "2025-09-02", "en", '<a href="x">Heavy rain</a> "quoted"')
    assert len(rows) == 3
    assert io.links_for_dates(df, "2025-09-03", 0).count() == 1
    assert io.links_for_dates(df, "2025-09-03", 1).count() == 3


def test_missing_inputs_are_empty(spark):
    assert io.read_source_directory(spark, "/nonexistent/dir.csv").count() == 0
    assert io.read_links(spark, "/nonexistent/tree").count() == 0


def test_write_links_roundtrip_and_clear(spark):
    df = io.read_links(spark, _tree()).drop("file", "seq")
    out = tempfile.mkdtemp(prefix="quern-hive-")
    io.write_links(df, out)
    back = io.read_links_hive(spark, out)
    assert back.count() == 3
    assert io.clear_link_range(spark, out, "2025-09-02", "2025-09-02", region="assam") == 1
    assert io.read_links_hive(spark, out).count() == 2


def _write(root, region, day, text):
    d = os.path.join(root, "states", region, "Monsoon", "2025", "09", day)
    os.makedirs(d)
    with open(os.path.join(d, "results.csv"), "w") as f:
        f.write(text)


def test_read_links_order_and_header(spark):
    """Input order is path then row, whatever the sizes; columns go by name; no Link column, no rows."""
    root = tempfile.mkdtemp(prefix="quern-links-")
    _write(root, "assam", "02", HEADER + ROW)
    _write(root, "bihar", "02", HEADER + ROW.replace("Daily", "first") + ROW.replace("Daily", "second") * 50)
    _write(root, "goa", "02", "Link,Title\nhttps://g/1,by name\n")
    _write(root, "kerala", "02", "Title,Date,Source\na,2025-09-02 10:00:00,s\n")
    rows = io.read_links(spark, root).orderBy("seq").collect()
    assert [r.region for r in rows] == ["assam"] + ["bihar"] * 51 + ["goa"]
    assert (rows[1].Source, rows[2].Source) == ("first", "second")
    assert (rows[-1].Link, rows[-1].Title, rows[-1].Date) == ("https://g/1", "by name", None)


def test_write_articles_keeps_other_days(spark):
    root = tempfile.mkdtemp(prefix="quern-articles-")
    df = spark.createDataFrame([("a", "high"), ("b", "low")], "title string, extraction_quality string")
    for day in ("2026-08-07", "2026-08-08", "2026-08-08"):
        io.write_articles(df, root, day)
    back = spark.read.json(root)
    assert sorted((str(r.extraction_date), r.title) for r in back.collect()) == [
        ("2026-08-07", "a"), ("2026-08-07", "b"), ("2026-08-08", "a"), ("2026-08-08", "b")]


def test_replace_links(spark):
    """Days of the range are cleared; rows in it go under the end date, once a link; nothing in, nothing done."""
    out = tempfile.mkdtemp(prefix="quern-range-")
    cols = "seq int, Link string, Title string, Date string, region_type string, region string, disaster_type string, run_date date"
    import datetime as dt
    place = ("states", "assam", "Monsoon")
    old = [(1, "old", "t", "2025-09-01 00:00:00", *place, dt.date(2025, 9, 1)), (2, "kept", "t", "2025-08-01 00:00:00", *place, dt.date(2025, 8, 1))]
    io.write_links(spark.createDataFrame(old, cols).drop("seq"), out)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    new = [(5, "x", "late", "2025-09-02 10:00:00", *place, None), (3, "x", "early", "2025-09-01 10:00:00", *place, None),
           (4, "y", "t", "2025-10-01 00:00:00", *place, None), (6, "z", "t", "no date", *place, None)]
    frame = spark.createDataFrame(new, cols)
    assert io.replace_links(frame.where("Link = 'y'"), out, "2025-09-01", "2025-09-03") == 0
    assert io.read_links_hive(spark, out).count() == 2
    assert io.replace_links(frame, out, "2025-09-01", "2025-09-03") == 1
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    got = sorted((r.Link, r.Title, str(r.run_date)) for r in io.read_links_hive(spark, out).collect())
    assert got == [("kept", "t", "2025-08-01"), ("x", "early", "2025-09-03")]


def test_stats_and_feed(spark):
    d = tempfile.mkdtemp(prefix="quern-stats-")
    for day, n in [("2026-08-07", 5), ("2026-08-08", 13)]:
        os.makedirs(os.path.join(d, day))
        with open(os.path.join(d, day, "extraction_stats.json"), "w") as f:
            json.dump({"extraction_date": day, "total_articles": n,
                       "language_stats": {"total_articles": n, "language_distribution":
                                          {"en": {"count": n, "percentage": 100.0}}},
                       "quality_breakdown": {"high": n, "medium": 0, "low": 0},
                       "region_breakdown": {"assam": n}, "disaster_breakdown": {"Monsoon": n},
                       "extraction_timestamp": f"{day} 05:00:00"}, f, indent=2)
    stats = io.read_run_stats(spark, os.path.join(d, "*", "extraction_stats.json"))
    latest = io.latest_run_stats(stats).first()
    assert latest.total_articles == 13 and latest.language_stats.language_distribution["en"]["count"] == 13
    feed = os.path.join(d, "feed.jsonl")
    with open(feed, "w") as f:
        f.write(json.dumps({"title": "t", "link": "https://a", "published": "Tue, 05 Mar 2024 20:00:00 GMT"}) + "\n")
    r = io.read_feed(spark, feed).first()
    assert r.summary == "" and r.source_title == ""


def test_read_feed_xml(spark):
    d = tempfile.mkdtemp(prefix="quern-rss-")
    path = os.path.join(d, "feed.xml")
    with open(path, "w") as f:
        f.write('<rss><channel>'
                '<item><title>Heavy rain</title><link>https://a/1</link>'
                '<pubDate>Tue, 05 Mar 2024 20:00:00 GMT</pubDate><description>d1</description>'
                '<source url="https://a">Daily A</source></item>'
                '<item><title>Flood</title><link>https://a/2</link>'
                '<pubDate>Wed, 06 Mar 2024 01:00:00 GMT</pubDate></item>'
                '</channel></rss>')
    rows = sorted((r.title, r.summary, r.source_title, r.published) for r in io.read_feed(spark, path, "xml").collect())
    assert rows == [("Flood", "", "", "Wed, 06 Mar 2024 01:00:00 GMT"),
                    ("Heavy rain", "d1", "Daily A", "Tue, 05 Mar 2024 20:00:00 GMT")]


# --- damaged link files (A1) and published replacement (A3) -----------------

def _put(root, region, data, day="2025/09/01"):
    d = os.path.join(root, "states", region, "Monsoon", day)
    os.makedirs(d)
    with open(os.path.join(d, "results.csv"), "wb") as f:
        f.write(data)


def test_damaged_files_are_left_out_and_named(spark):
    root = tempfile.mkdtemp(prefix="quern-damaged-")
    wide = [f"c{i}" for i in range(29)] + ["Link"]
    _put(root, "assam", b'Title,Link,Summary\na,https://x/1,"two\nlines, ""quoted"""\nb,https://x/2\n')
    _put(root, "bihar", (",".join(wide) + "\n" + ",".join(["v"] * 29 + ["https://x/30"]) + "\n").encode())
    _put(root, "goa", b"\xef\xbb\xbfLink,Title\r\nhttps://x/bom,t,,\r\n")                    # byte order mark, empty cells over
    _put(root, "kerala", b'Title,Link\na,"https://x/3\nb,https://x/4\n')                      # a broken quote
    _put(root, "punjab", b'Title,Link,Summary\na,https://x/5,"cut in the mid')                 # truncated
    _put(root, "odisha", b"Title,Url\na,https://x/6\n")
    _put(root, "sikkim", b"Title,Link\na,https://x/7\nb,https://x/8,third\n")
    _put(root, "tripura", b"Title,Link\n\xff\xfe,https://x/9\n")
    _put(root, "manipur", b"")
    got = {(r["region"], r["Link"]) for r in io.read_links(spark, root).collect()}
    assert got == {("assam", "https://x/1"), ("assam", "https://x/2"), ("bihar", "https://x/30"), ("goa", "https://x/bom")}
    why = {r["file"].split("/states/")[1].split("/")[0]: r["reason"] for r in io.link_rejects(spark, root).collect()}
    why.pop("manipur", None)
    assert why == {"kerala": "unclosed quote", "punjab": "unclosed quote", "odisha": "no Link column",
                   "sikkim": "more cells than the header", "tripura": "not UTF-8"}


def _day_rows(spark, links, day="2025-09-01 10:00:00"):
    rows = [(i, link, "t", d, "states", "assam", "Monsoon") for i, (link, d) in enumerate((x if isinstance(x, tuple) else (x, day)) for x in links)]
    return spark.createDataFrame(rows, "seq int, Link string, Title string, Date string, region_type string, region string, disaster_type string")


def test_a_writer_that_stops_leaves_the_old_days(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="quern-atomic-")
    read = lambda **o: sorted((r["Link"], str(r["run_date"])) for r in io.read_links_hive(spark, root, **o).collect())
    assert io.replace_links(_day_rows(spark, ["a", "b"]), root, "2025-09-01", "2025-09-01") == 2
    assert io.replace_links(_day_rows(spark, ["far"], "2025-10-05 00:00:00"), root, "2025-10-05", "2025-10-05") == 1
    before = read()

    def stop(*args):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(io, "_publish", stop)
        with pytest.raises(OSError):
            io.replace_links(_day_rows(spark, ["c"]), root, "2025-09-01", "2025-09-01")
    assert read() == before == [("a", "2025-09-01"), ("b", "2025-09-01"), ("far", "2025-10-05")]
    assert io.replace_links(_day_rows(spark, ["c"]), root, "2025-09-01", "2025-09-02") == 1
    assert read() == [("c", "2025-09-02"), ("far", "2025-10-05")]
    assert read(start="2025-10-01", end="2025-10-31") == [("far", "2025-10-05")] and read(end="2025-01-01") == []
    assert io.drop_unpublished(spark, root) == 2 and read() == [("c", "2025-09-02"), ("far", "2025-10-05")]
    # Two writers on one version: the second is told.
    version, live = io.published_links(spark, root)
    io._publish(spark, root, version + 1, live)
    with pytest.raises(RuntimeError):
        io._publish(spark, root, version + 1, [])
    assert read() == [("c", "2025-09-02"), ("far", "2025-10-05")]


def test_repeated_links_go_before_bad_dates(spark):
    root = tempfile.mkdtemp(prefix="quern-order-")
    rows = _day_rows(spark, [("x", "no date"), ("x", "2025-09-01 10:00:00"), ("y", "2025-09-01 10:00:00"), ("y", None)])
    assert io.replace_links(rows, root, "2025-09-01", "2025-09-01") == 1
    assert [r["Link"] for r in io.read_links_hive(spark, root).collect()] == ["y"]


@pytest.mark.parametrize("query, module, sink, folder, times", [
    ("write_links_range", "io", "replace_links", "range-links", 2),
    ("run_stats_deduplication", "G", "run_stats", "stats-", 1),
    ("articles_two_days", "io", "write_articles", "two-days-survivors", 2),
    ("run_stats_roundtrip", "G", "run_stats", "stats-survivors", 2),
])
def test_round_trips_make_their_rows_once(spark, monkeypatch, query, module, sink, folder, times):
    """Every write takes rows that lie in a table: none goes back to the source's texts or dates."""
    from conftest import SF
    from quern.plans import q_sources as Q
    seen = []
    inner = getattr(getattr(Q, module), sink)

    def noted(df, *args, **kw):
        seen.append(df.inputFiles())
        return inner(df, *args, **kw)
    monkeypatch.setattr(getattr(Q, module), sink, noted)
    assert getattr(Q, query)(spark, SF).count() > 0
    assert len(seen) == times and all(files and all(f"/{folder}" in f for f in files) for files in seen)
