"""Page extraction (D1–D6, B11, H4) over a ``pages(page_id, url, html)`` table.

One ``mapInArrow`` pass parses each page once with the standard-library
``html.parser`` and emits the structural facts every cascade needs
(headings, title, metas, paragraphs, containers, anchors, date/summary
candidates).  The cascades themselves — which candidate wins, length
thresholds, fallbacks — are native ``coalesce``/array expressions, so
they stay in the JVM and are visible to the optimizer.  A worker hands
its rows on after about ``BATCH_CHARS`` characters of HTML and takes a
page's tree apart when it is read, so what it holds does not grow with
the rows of a batch.

Tree rules follow the lenient parser the reference used: an end tag
closes the nearest open element of that name (unknown end tags are
ignored), ``<p>`` is not closed implicitly, void elements never nest,
text inside ``<script>``/``<style>`` is not page text, entities are
decoded.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import dates as Dt
from quern.functions import lang as L
from quern.functions import relevance as R
from quern.functions.text import clip, py_strip

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}

# Selector cascades of the page extractors, in order.
CONTAINER_SELECTORS = ["article", ".article", ".content", ".story", "main", "#content",
                       ".post-content", ".news-content"]
RENDERED_SELECTORS = ["article", ".article", ".content", ".story", "main", "#content", ".post-content"]
DATE_META = [("property", "article:published_time"), ("name", "publishdate"), ("name", "date"),
             ("property", "og:updated_time")]
DATE_SELECTORS = [".publish-date", ".article-date", ".date", ".timestamp", '[class*="date"]',
                  '[class*="time"]', ".byline-date"]
SUMMARY_SELECTORS = [".article-summary", ".lead", ".excerpt", ".description", '[class*="summary"]',
                     '[class*="lead"]']
TEXT_DATE_PATTERNS = [r"(\d{1,2}\s+[A-Za-z]+\s+\d{4})", r"([A-Za-z]+\s+\d{1,2},\s+\d{4})",
                      r"(\d{4}-\d{2}-\d{2})", r"(\d{1,2}/\d{1,2}/\d{4})"]
TITLE_SUFFIXES = [" - Times of India", " | The Hindu", " - News18", " | NDTV"]
LINK_SKIP = [".jpg", ".png", ".pdf", ".mp4", "facebook.com", "twitter.com", "instagram.com"]
LINK_HREF_WORDS = ["weather", "rain", "flood", "monsoon", "storm"]
SECTION_CLASS = re.compile(r"news|weather|local|state|national", re.I)
SUMMARY_SKIP = ["cookie", "subscribe", "follow us"]

PAGE_SCHEMA = (
    "page_id long, url string, h1s array<string>, title string, "
    "metas map<string,string>, ps array<string>, "
    "containers array<struct<sel:int,pos:int,text_len:int,text:string,n_p:int,paras:array<string>>>, "
    "divs array<struct<n_p:int,pos:int,text_len:int,text:string,paras:array<string>>>, "
    "anchors array<struct<href:string,text:string,parent_hit:boolean,in_section:boolean>>, "
    "date_texts array<string>, summary_texts array<string>, text_dates array<string>"
)


#: Characters of HTML that a worker parses before it hands their rows on, about.
BATCH_CHARS = 1_000_000


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def classes(self):
        return (self.attrs.get("class") or "").split()

    def text(self, sep=""):
        out = []
        stack = [self]
        # iterative pre-order walk (pages can nest deeply)
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in HIDDEN:
                stack.extend(reversed(n.children))
        return sep.join(out)

    def find_all(self, pred):
        res, stack = [], list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                continue
            if pred(n):
                res.append(n)
            stack.extend(reversed(n.children))
        return res


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        d = {}
        for k, v in attrs:
            d.setdefault(k, v if v is not None else "")
        n = _Node(tag, d, self.cur)
        self.cur.children.append(n)
        if tag not in VOID:
            self.cur = n

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.cur = self.cur.parent

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def _strip(s: str) -> str:
    return s.strip()


def _matches(n: _Node, sel: str) -> bool:
    if sel.startswith("."):
        return sel[1:] in n.classes()
    if sel.startswith("#"):
        return n.attrs.get("id") == sel[1:]
    if sel.startswith("[class*="):
        return sel[9:-2] in (n.attrs.get("class") or "")
    return n.tag == sel


def parse_page(page_id, url, html, link_terms):
    t = _Tree()
    try:
        t.feed(html or "")
        t.close()
    except Exception:  # noqa: BLE001 — a malformed page yields what was parsed
        pass
    root = t.root
    everything = root.find_all(lambda n: True)
    pos = {id(n): i for i, n in enumerate(everything)}
    h1s = [_strip(n.text()) for n in everything if n.tag == "h1"]
    titles = [n for n in everything if n.tag == "title"]
    metas = {}
    for n in everything:
        if n.tag == "meta":
            for key in ("name", "property"):
                v = n.attrs.get(key)
                if v is not None and f"{key}:{v}" not in metas:
                    metas[f"{key}:{v}"] = n.attrs.get("content")
    p_nodes = [n for n in everything if n.tag == "p"]
    ps = [_strip(n.text()) for n in p_nodes]
    containers = []
    for si, sel in enumerate(CONTAINER_SELECTORS):
        for n in everything:
            if _matches(n, sel):
                inner_p = n.find_all(lambda m: m.tag == "p")
                txt = n.text()
                containers.append({"sel": si, "pos": pos[id(n)], "text_len": len(txt),
                                   "text": "\n".join(s.strip() for s in n.text("\u0000").split("\u0000") if s.strip()),
                                   "n_p": len(inner_p), "paras": [_strip(m.text()) for m in inner_p]})
    divs = []
    if not containers:
        counted = []
        for n in everything:
            if n.tag == "div":
                inner_p = n.find_all(lambda m: m.tag == "p")
                if len(inner_p) >= 3:
                    counted.append((n, inner_p))
        counted.sort(key=lambda x: -len(x[1]))  # stable: document order on ties
        for n, inner_p in counted[:3]:
            divs.append({"n_p": len(inner_p), "pos": pos[id(n)], "text_len": len(n.text()),
                         "text": "\n".join(s.strip() for s in n.text("\u0000").split("\u0000") if s.strip()),
                         "paras": [_strip(m.text()) for m in inner_p]})
    low_terms = [x.lower() for x in link_terms[:5]]
    sections = {id(n) for n in everything if n.tag in ("div", "section")
                and any(SECTION_CLASS.search(c) for c in n.classes() + [n.attrs.get("class") or ""]
                        if n.attrs.get("class"))}
    anchors = []
    for n in everything:
        if n.tag == "a" and "href" in n.attrs:
            par = n.parent
            hit = False
            if par is not None and low_terms:
                ptxt = par.text().lower()
                hit = any(x in ptxt for x in low_terms)
            up, in_sec = n.parent, False
            while up is not None:
                if id(up) in sections:
                    in_sec = True
                    break
                up = up.parent
            anchors.append({"href": n.attrs.get("href") or "", "text": n.text(), "parent_hit": hit,
                            "in_section": in_sec})
    date_texts = []
    for sel in DATE_SELECTORS:
        m = next((n for n in everything if _matches(n, sel)), None)
        date_texts.append(_strip(m.text()) if m is not None else None)
    summary_texts = []
    for sel in SUMMARY_SELECTORS:
        m = next((n for n in everything if _matches(n, sel)), None)
        summary_texts.append(_strip(m.text()) if m is not None else None)
    full = root.text()
    text_dates = []
    for pat in TEXT_DATE_PATTERNS:
        m = re.search(pat, full)
        text_dates.append(m.group(1) if m else None)
    title = titles[0].text() if titles else None
    for n in everything:  # nodes and parents hold each other: apart, they are freed at once
        n.parent, n.children = None, []
    return {"page_id": page_id, "url": url, "h1s": h1s, "title": title,
            "metas": metas, "ps": ps, "containers": containers, "divs": divs, "anchors": anchors,
            "date_texts": date_texts, "summary_texts": summary_texts, "text_dates": text_dates}


def parse_pages(pages: DataFrame, link_terms: list[str] | None = None, page_id: str = "page_id",
                url: str = "url", html: str = "html") -> DataFrame:
    """The page-parsing job: one pass per page, Arrow batches in, smaller ones out."""
    from quern.session import ship_package
    ship_package(pages.sparkSession)
    terms = list(link_terms or [])

    def run(batches):
        for b in batches:
            yield from parsed_batches(b, terms)

    return pages.select(page_id, url, html).mapInArrow(run, PAGE_SCHEMA)


def parsed_batches(batch, terms: list[str]):
    """The parsed pages of an Arrow batch (page_id, url, html), in batches of about ``BATCH_CHARS`` characters of HTML."""
    import pyarrow as pa
    schema = _page_arrow()
    rows, chars = [], 0
    for i, u, h in zip(*batch.columns):  # a value at a time, not the whole batch as Python objects
        html = h.as_py()
        row = parse_page(i.as_py(), u.as_py(), html, terms)
        rows.append(row | {"metas": list(row["metas"].items())})
        chars += len(html or "")
        if chars >= BATCH_CHARS:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, chars = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def _page_arrow():
    """``PAGE_SCHEMA`` in Arrow's types."""
    import pyarrow as pa
    text, many = pa.string(), pa.list_(pa.string())
    block = [("pos", pa.int32()), ("text_len", pa.int32()), ("text", text)]
    return pa.schema([
        ("page_id", pa.int64()), ("url", text), ("h1s", many), ("title", text), ("metas", pa.map_(text, text)), ("ps", many),
        ("containers", pa.list_(pa.struct([("sel", pa.int32()), *block, ("n_p", pa.int32()), ("paras", many)]))),
        ("divs", pa.list_(pa.struct([("n_p", pa.int32()), *block, ("paras", many)]))),
        ("anchors", pa.list_(pa.struct([("href", text), ("text", text), ("parent_hit", pa.bool_()), ("in_section", pa.bool_())]))),
        ("date_texts", many), ("summary_texts", many), ("text_dates", many)])


# ------------------------------------------------------------------ cascades (native)

def _first(arr: Column, pred) -> Column:
    return F.try_element_at(F.filter(arr, pred), F.lit(1))


def page_title(p: DataFrame) -> Column:
    """D1 — first h1 with 10 < len < 200; else <title> minus one known suffix
    (each tested once, in order) if len > 10; else og:title; else null."""
    h1 = _first(F.col("h1s"), lambda x: (F.length(x) > 10) & (F.length(x) < 200))
    t = py_strip(F.col("title"))
    for suf in TITLE_SUFFIXES:  # each suffix tested once, in order
        t = F.regexp_replace(t, r"\Q" + suf + r"\E$", "")
    title = F.when(F.col("title").isNotNull() & (F.length(t) > 10), t)
    og = py_strip(F.try_element_at(F.col("metas"), F.lit("property:og:title")))
    og = F.when(og != "", og)
    return F.coalesce(h1, title, og)


def page_summary(p: DataFrame) -> Column:
    """D3 — meta description > 50 → first p > 50 without cookie/subscribe/follow us
    → first of 6 summary selectors > 50; each clipped to 300; else ''."""
    desc = py_strip(F.try_element_at(F.col("metas"), F.lit("name:description")))
    d1 = F.when(F.length(desc) > 50, clip(desc, 300))

    def ok(x):
        low = F.lower(x)
        c = F.length(x) > 50
        for s in SUMMARY_SKIP:
            c = c & (F.instr(low, s) == 0)
        return c
    d2 = clip(_first(F.col("ps"), ok), 300)
    d3 = clip(_first(F.col("summary_texts"), lambda x: x.isNotNull() & (F.length(x) > 50)), 300)
    return F.coalesce(d1, d2, d3, F.lit(""))


def page_date(url: Column, ref_date: str) -> Column:
    """D2 — URL date → date metas → date selectors (C7/C8) → text patterns.

    The date parser is applied through ``transform`` over the candidate
    arrays, so its (large) expression appears once in the plan.
    """
    metas = F.array(*[F.try_element_at(F.col("metas"), F.lit(f"{k}:{v}")) for k, v in DATE_META])

    def meta_date(m):
        d = F.substring_index(m, "T", 1)
        return F.when(d.rlike(r"^\d{4}-(?:1[0-2]|0[1-9]|[1-9])-(?:3[01]|[12]\d|0[1-9]|[1-9])$"),
                      F.try_to_date(d, "yyyy-M-d"))
    texts = F.concat(F.col("date_texts"), F.col("text_dates"))
    cands = F.concat(F.array(Dt.date_from_url(url)), F.transform(metas, meta_date),
                     F.transform(texts, lambda x: Dt.parse_date_string(x, ref_date)))
    return F.try_element_at(F.filter(cands, lambda x: x.isNotNull()), F.lit(1))


def page_body() -> Column:
    """D4 — best container (longest text; ties → first) → its p > 20 joined,
    or its whole text; if < 200 chars, all p > 30; accepted if title and > 200."""
    cands = F.when(F.size("containers") > 0,
                   F.transform("containers", lambda c: F.struct(c["text_len"].alias("n"), c["sel"].alias("a"),
                                                               c["pos"].alias("b"), c["paras"].alias("paras"),
                                                               c["text"].alias("text"))))
    divs = F.transform(F.coalesce(F.col("divs"), F.array()), lambda c: F.struct(
        c["text_len"].alias("n"), F.lit(0).alias("a"), c["pos"].alias("b"), c["paras"].alias("paras"),
        c["text"].alias("text")))
    pool = F.coalesce(cands, divs)
    best = F.try_element_at(F.array_sort(pool, lambda x, y: F.when(x["n"] > y["n"], -1).when(x["n"] < y["n"], F.lit(1))
                                     .when(x["a"] < y["a"], -1).when(x["a"] > y["a"], 1)
                                     .when(x["b"] < y["b"], -1).when(x["b"] > y["b"], 1).otherwise(0)), F.lit(1))
    paras = F.filter(best["paras"], lambda x: F.length(x) > 20)
    body = F.when(best.isNull(), F.lit("")).when(F.size(best["paras"]) > 0, F.array_join(paras, "\n")) \
        .otherwise(best["text"])
    all_p = F.array_join(F.filter("ps", lambda x: F.length(x) > 30), "\n")
    return F.when(F.length(body) < 200, all_p).otherwise(body)


def rendered_body() -> Column:
    """D6 — first of 7 container selectors (its text); if missing or < 200,
    all p > 30 joined; accepted when > 200."""
    first = F.try_element_at(F.array_sort(F.filter("containers", lambda c: c["sel"] < len(RENDERED_SELECTORS)),
                                      lambda x, y: F.when(x["sel"] < y["sel"], -1).when(x["sel"] > y["sel"], 1)
                                      .when(x["pos"] < y["pos"], -1).when(x["pos"] > y["pos"], 1).otherwise(0)), F.lit(1))
    c = first["text"]
    all_p = F.array_join(F.filter("ps", lambda x: F.length(x) > 30), "\n")
    out = F.when(c.isNull() | (F.length(c) < 200), F.when(F.length(all_p) > 0, all_p).otherwise(c)).otherwise(c)
    return F.when(F.length(out) > 200, out)


def page_fields(parsed: DataFrame, ref_date: str = "2024-01-31") -> DataFrame:
    """D1–D4, D6 and C10 for every page (one row per page)."""
    x = parsed.select(
        "page_id", "url",
        page_title(parsed).alias("page_title"),
        page_summary(parsed).alias("summary"),
        page_date(F.col("url"), ref_date).alias("page_date"),
        F.coalesce(py_strip(F.try_element_at("h1s", F.lit(1))), py_strip(F.col("title"))).alias("body_title"),
        page_body().alias("body"),
        rendered_body().alias("rendered_body"),
    )
    return x.withColumn("body", F.when(F.col("body_title").isNotNull() & (F.length("body") > 200), F.col("body"))) \
        .withColumn("body_language", L.script_language_dominant(F.coalesce(F.col("body"), F.lit(""))))


def absolutize(href: Column, base_url: Column) -> Column:
    """'/x' → scheme://host/x; absolute http(s) kept; anything else null."""
    base = F.regexp_extract(base_url, r"^([^/]*/[^/]*/[^/]*)", 1)
    return (F.when(href.startswith("/"), F.concat(base, href))
            .when(href.startswith("http://") | href.startswith("https://"), href))


def page_links(parsed: DataFrame, terms: list[str], run_date: str) -> DataFrame:
    """D5 — all candidate article links of each page (three strategies),
    distinct in first-seen order.

    Everything is per-row array work on the page's anchors: no shuffle.
    """
    t8 = [x.lower() for x in terms[:8]]
    y, m, d = run_date.split("-")
    today = [f"{y}/{m}/{d}", f"{y}-{m}-{d}", f"{y}{m}{d}"]

    def s1(a):
        h = absolutize(a["href"], F.col("url"))
        low = F.lower(h)
        skip = F.lit(False)
        for s in LINK_SKIP:
            skip = skip | (F.instr(low, s) > 0)
        ltxt = F.lower(py_strip(a["text"]))
        by_text = F.lit(False)
        for x in t8:
            by_text = by_text | (F.instr(ltxt, x) > 0)
        by_href = F.lit(False)
        for w in LINK_HREF_WORDS:
            by_href = by_href | (F.instr(low, w) > 0)
        return F.when(h.isNotNull() & ~skip & (by_text | by_href | a["parent_hit"]), h)

    def s2(a):
        h = absolutize(a["href"], F.col("url"))
        low = F.lower(h)
        return F.when(h.isNotNull() & a["in_section"] & ((F.instr(low, "article") > 0) | (F.instr(low, "news") > 0)), h)

    def s3(a):
        h = a["href"]
        has = F.lit(False)
        for pat in today:
            has = has | (F.instr(h, pat) > 0)
        return F.when(has & (h.startswith("http://") | h.startswith("https://")), h)

    found = F.concat(F.transform("anchors", s1), F.transform("anchors", s2), F.transform("anchors", s3))
    links = F.array_distinct(F.filter(found, lambda x: x.isNotNull()))
    return parsed.select("page_id", F.posexplode(links).alias("link_ord", "link"))


def first_n(rows: DataFrame, n: int, order: str = "link_ord") -> DataFrame:
    """H4 — the first ``n`` rows of each group; ``order`` already numbers them from 0."""
    return rows.where(F.col(order) < n)


def validate_page_article(fields: DataFrame, terms, start: str, end: str, source: str = "",
                          irrelevant=R.IRRELEVANT, context=R.CONTEXT) -> DataFrame:
    """B11 — title relevant → page date in range → title + summary relevant →
    the 7-column link row (summary clipped to 200, date at 00:00:00, C9 language)."""
    x = fields.where(F.col("page_title").isNotNull()
                     & R.is_relevant(F.col("page_title"), terms, irrelevant, context))
    x = x.where(F.col("page_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    combined = F.concat(F.col("page_title"), F.lit(" "), F.col("summary"))
    x = x.where(R.is_relevant(combined, terms, irrelevant, context))
    return x.select(F.col("page_title").alias("Title"), F.col("url").alias("Link"),
                    F.concat(F.date_format("page_date", "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("Date"),
                    F.lit(source).alias("Source"), clip(F.col("summary"), 200).alias("Summary"),
                    F.lit("Monsoon").alias("Term"), L.script_language_first(combined).alias("LanguageQueried"))


__all__ = ["parse_pages", "page_fields", "page_links", "first_n", "validate_page_article"]
