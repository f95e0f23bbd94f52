"""URL scalars (C1–C4, C14, C16, B1–B3) as native Column expressions.

The split follows RFC 3986 / Python ``urlsplit``: fragment after the
first '#', query after the first '?' before it, authority after a
leading ``scheme://``.  ``parse_url`` is avoided on purpose: it throws
on malformed input under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import _c, py_strip

# Query parameters dropped by normalize_url (exact case).
TRACKING_PARAMS = ["utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term",
                   "fbclid", "gclid", "_ga", "_gac", "ref", "source", "medium",
                   "campaign", "oc"]

# URL patterns that make an extraction slow (B2), case-sensitive.
PROBLEMATIC_PATTERNS = [r"news\.google\.com/rss/articles/CBMi[a-zA-Z0-9]{100,}",
                        r"facebook\.com", r"twitter\.com", r"instagram\.com",
                        r"linkedin\.com", r"youtube\.com"]

# Social domains skipped before fetching (B3), matched on lower(url).
SKIP_DOMAINS = ["facebook.com", "twitter.com", "instagram.com", "youtube.com"]

GOOGLE_RSS = "news.google.com/rss/articles/"

AUTHORITY_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def google_article_id(url) -> Column:
    """C4 — the id after ``/articles/`` up to '?' ('' when absent)."""
    return F.regexp_extract(_c(url), r"/articles/([^?]+)", 1)


def _decode(x: Column) -> Column:
    # parse_qs: '+' is a space, then percent-decoding; malformed escapes stay.
    y = F.regexp_replace(x, r"\+", " ")
    return F.coalesce(F.try_url_decode(y), y)


def _encode(x: Column) -> Column:
    # quote_plus: unreserved A-Z a-z 0-9 _ . - ~ stay, space -> '+'.
    # URLEncoder keeps '*' and escapes '~'; patch both.
    e = F.url_encode(x)
    return F.replace(F.replace(e, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _clean_query(query: Column, drop=TRACKING_PARAMS) -> Column:
    """parse_qs → drop names → urlencode(doseq=True).

    Blank values and pairs without '=' vanish; repeated names are grouped
    at the position of their first occurrence.
    """
    pairs = F.filter(F.split(query, "&"),
                     lambda p: (F.instr(p, "=") > 0) & (F.length(F.substring_index(p, "=", 1)) < F.length(p) - 1))
    kv = F.transform(pairs, lambda p: F.struct(
        _decode(F.substring_index(p, "=", 1)).alias("k"),
        _decode(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("v")))
    dropped = F.array(*[F.lit(d) for d in drop])
    kept = F.filter(kv, lambda s: ~F.array_contains(dropped, s["k"]))
    keys = F.transform(kept, lambda s: s["k"])
    ordered = F.array_sort(F.transform(kept, lambda s, i: F.struct(
        F.array_position(keys, s["k"]).alias("first"), i.alias("pos"), s["k"].alias("k"), s["v"].alias("v"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat(_encode(s["k"]), F.lit("="), _encode(s["v"]))), "&")


def normalize_url(url, drop=TRACKING_PARAMS) -> Column:
    """C1 — canonical URL used as the stage-1 dedup key."""
    u = F.coalesce(_c(url), F.lit(""))
    gid = google_article_id(u)
    pre_frag = F.substring_index(u, "#", 1)
    has_q = F.instr(pre_frag, "?") > 0
    base = F.substring_index(pre_frag, "?", 1)
    query = F.regexp_extract(pre_frag, r"^[^?]*\?(.*)$", 1)
    q2 = F.when(has_q & (query != ""), _clean_query(query, drop)).otherwise(F.lit(""))
    rebuilt = F.when(q2 != "", F.concat(base, F.lit("?"), q2)).otherwise(base)
    canon = F.regexp_replace(F.lower(rebuilt), "/+$", "")
    return (F.when((F.instr(u, GOOGLE_RSS) > 0) & (gid != ""), F.concat(F.lit("google_news_"), gid))
            .otherwise(canon))


def netloc(url) -> Column:
    return F.regexp_extract(F.coalesce(_c(url), F.lit("")), AUTHORITY_RE, 1)


def extract_domain(url) -> Column:
    """C2 — lower-cased authority (port kept) without one leading 'www.'."""
    return F.regexp_replace(F.lower(netloc(url)), r"^www\.", "")


def extract_main_domain(domain) -> Column:
    """C3 — last two dot-separated labels."""
    return F.substring_index(_c(domain), ".", -2)


def url_path(url) -> Column:
    """``urlparse(url).path`` (``;params`` of the last segment removed)."""
    u = F.substring_index(F.substring_index(F.coalesce(_c(url), F.lit("")), "#", 1), "?", 1)
    rest = F.regexp_replace(u, AUTHORITY_RE, "")
    rest = F.regexp_replace(rest, r"^[A-Za-z][A-Za-z0-9+.\-]*:(?!//)", "")
    return F.regexp_replace(rest, r";[^/]*$", "")


def path_similarity(url_a, url_b) -> Column:
    """C16 — |A∩B| / max(|A|,|B|,1) over sets of '/'-separated lower path parts."""
    a = F.array_distinct(F.split(F.lower(url_path(url_a)), "/"))
    b = F.array_distinct(F.split(F.lower(url_path(url_b)), "/"))
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b), F.lit(1))


def article_id(normalized_url, title) -> Column:
    """C14 — md5(normalized_url ‖ title)."""
    return F.md5(F.concat(F.coalesce(_c(normalized_url), F.lit("")), F.coalesce(_c(title), F.lit(""))))


def valid_link(url) -> Column:
    """B1 — trimmed link starts with http:// or https://."""
    t = py_strip(F.coalesce(_c(url), F.lit("")))
    return t.startswith("http://") | t.startswith("https://")


def is_problematic_url(url, patterns=PROBLEMATIC_PATTERNS) -> Column:
    """B2 — any of the slow-extraction patterns (case-sensitive)."""
    return F.coalesce(_c(url), F.lit("")).rlike("|".join(f"(?:{p})" for p in patterns))


def should_skip_url(url, domains=SKIP_DOMAINS) -> Column:
    """B3 — very long Google RSS link or a social domain."""
    u = F.coalesce(_c(url), F.lit(""))
    low = F.lower(u)
    social = F.lit(False)
    for d in domains:
        social = social | (F.instr(low, d) > 0)
    return ((F.instr(u, GOOGLE_RSS + "CBMi") > 0) & (F.length(u) > 350)) | social
