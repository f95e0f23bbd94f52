"""DuckDB SQL fragments for the independent oracle.

Every query in the catalog is checked against a hand-written DuckDB
statement.  These helpers spell the same rules in DuckDB's dialect
(RE2 regexes, ``lambda x:`` list lambdas, ``'g'`` flag for global
replace, explicit URL codec fixes) so the oracle shares no code path
with the Spark expressions.
"""

from __future__ import annotations

from quern.functions.quality import BOILERPLATE
from quern.functions.text import TITLE_STOP_WORDS, WORD, WS
from quern.functions.url import PROBLEMATIC_PATTERNS, SKIP_DOMAINS, TRACKING_PARAMS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(xs) -> str:
    return "[" + ", ".join(lit(x) for x in xs) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def quality(x: str, boiler=BOILERPLATE) -> str:
    n = f"length({x})"
    paras = f"len(list_filter(string_split({x}, chr(10)), lambda l: length({strip('l')}) > 20))"
    html = f"regexp_matches({x}, '<[^>]+>')"
    poor = "(" + " + ".join(f"(CASE WHEN contains(lower({x}), {lit(p)}) THEN 1 ELSE 0 END)" for p in boiler) + ")"
    w = words(x)
    ratio = f"(CASE WHEN len({w}) > 0 THEN len(list_distinct({w})) / len({w}) ELSE 0 END)"
    return (f"(CASE WHEN {x} IS NULL OR {n} = 0 THEN 'low' "
            f"WHEN {n} > 1500 AND {paras} >= 3 AND NOT {html} AND {poor} <= 1 AND {ratio} > 0.3 THEN 'high' "
            f"WHEN {n} > 500 AND {paras} >= 2 AND {poor} <= 2 AND {ratio} > 0.2 THEN 'medium' "
            f"ELSE 'low' END)")


def rank(q: str) -> str:
    return f"(CASE WHEN {q} = 'high' THEN 3 WHEN {q} = 'medium' THEN 2 ELSE 1 END)"


def fingerprint(x: str) -> str:
    c = collapse(f"lower({x})")
    return (f"(CASE WHEN {x} IS NULL OR length({x}) < 100 THEN NULL ELSE md5("
            f"substring({c}, 1, 500) || '||' || (CASE WHEN length({c}) > 200 THEN right({c}, 200) ELSE '' END)"
            f" || '||' || CAST(length({c}) // 100 AS VARCHAR)) END)")


def title_key(t: str, stops=TITLE_STOP_WORDS) -> str:
    low = f"lower(coalesce({t}, ''))"
    w = f"regexp_extract_all({strip(low)}, '{WORD}')"
    sig = f"list_filter({w}, lambda w: length(w) > 3 AND NOT list_contains({lst(stops)}, w))"
    return f"array_to_string(list_sort(list_slice({sig}, 1, 5)), ' ')"


AUTH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def netloc(u: str) -> str:
    return f"regexp_extract(coalesce({u}, ''), '{AUTH}', 1)"


def domain(u: str) -> str:
    return f"regexp_replace(lower({netloc(u)}), '^www\\.', '')"


def main_domain(d: str) -> str:
    return f"(CASE WHEN position('.' IN {d}) > 0 THEN regexp_extract({d}, '([^.]*\\.[^.]*)$', 1) ELSE {d} END)"


def _dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def normalize_url(u: str, drop=TRACKING_PARAMS) -> str:
    uu = f"coalesce({u}, '')"
    gid = f"regexp_extract({uu}, '/articles/([^?]+)', 1)"
    pre = f"split_part({uu}, '#', 1)"
    base = f"split_part({pre}, '?', 1)"
    query = f"regexp_extract({pre}, '^[^?]*\\?(.*)$', 1)"
    pairs = (f"list_filter(string_split({query}, '&'), lambda p: position('=' IN p) > 0 "
             f"AND length(split_part(p, '=', 1)) < length(p) - 1)")
    k = _dec("split_part(p, '=', 1)")
    v = _dec("regexp_extract(p, '^[^=]*=(.*)$', 1)")
    kv = f"list_transform({pairs}, lambda p: {{'k': {k}, 'v': {v}}})"
    kept = f"list_filter({kv}, lambda s: NOT list_contains({lst(drop)}, s.k))"
    ordered = (f"list_sort(list_transform({kept}, lambda s, i: {{'first': list_position(list_transform({kept}, "
               f"lambda t: t.k), s.k), 'pos': i, 'k': s.k, 'v': s.v}}))")
    q2 = f"array_to_string(list_transform({ordered}, lambda s: {_enc('s.k')} || '=' || {_enc('s.v')}), '&')"
    q2 = f"(CASE WHEN position('?' IN {pre}) > 0 AND {query} <> '' THEN {q2} ELSE '' END)"
    rebuilt = f"(CASE WHEN {q2} <> '' THEN {base} || '?' || {q2} ELSE {base} END)"
    canon = f"regexp_replace(lower({rebuilt}), '/+$', '')"
    return (f"(CASE WHEN position('news.google.com/rss/articles/' IN {uu}) > 0 AND {gid} <> '' "
            f"THEN 'google_news_' || {gid} ELSE {canon} END)")


def url_path(u: str) -> str:
    x = f"split_part(split_part(coalesce({u}, ''), '#', 1), '?', 1)"
    x = f"regexp_replace({x}, '{AUTH}', '')"
    x = f"(CASE WHEN regexp_matches({x}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') AND NOT regexp_matches({x}, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN regexp_replace({x}, '^[A-Za-z][A-Za-z0-9+.\\-]*:', '') ELSE {x} END)"
    return f"regexp_replace({x}, ';[^/]*$', '')"


def path_similarity(a: str, b: str) -> str:
    pa = f"list_distinct(string_split(lower({url_path(a)}), '/'))"
    pb = f"list_distinct(string_split(lower({url_path(b)}), '/'))"
    return f"(len(list_intersect({pa}, {pb})) / greatest(len({pa}), len({pb}), 1))"


def valid_link(u: str) -> str:
    t = strip(f"coalesce({u}, '')")
    return f"(starts_with({t}, 'http://') OR starts_with({t}, 'https://'))"


def problematic(u: str, pats=PROBLEMATIC_PATTERNS) -> str:
    alt = "|".join(f"(?:{p})" for p in pats)
    return f"regexp_matches(coalesce({u}, ''), {lit(alt)})"


def should_skip(u: str, doms=SKIP_DOMAINS) -> str:
    uu = f"coalesce({u}, '')"
    social = " OR ".join(f"contains(lower({uu}), {lit(d)})" for d in doms)
    return (f"((contains({uu}, 'news.google.com/rss/articles/CBMi') AND length({uu}) > 350) OR {social})")


# ---------------------------------------------------------------- adapters

ARTICLES = f"""
SELECT doc_id AS seq, doc_id,
       split_part(text, chr(10), 1) AS title,
       'https://d' || CAST((doc_id // 4) % 2 AS VARCHAR) || '.example.com/a/' || CAST(doc_id // 4 AS VARCHAR) AS final_url,
       text AS article_text, lang AS article_language, source AS state, 'Monsoon' AS disaster_type,
       {quality('text')} AS extraction_quality
FROM documents
"""


def articles_cte() -> str:
    return f"""articles AS (
  SELECT *, final_url AS original_url, {normalize_url('final_url')} AS normalized_url FROM ({ARTICLES})
)"""


def dedup_keys_cte() -> str:
    tkey = (f"(CASE WHEN {domain('final_url')} <> '' AND {strip("lower(coalesce(title, ''))")} <> '' "
            f"THEN {domain('final_url')} || '::' || {title_key('title')} END)")
    return f"""keys AS (
  SELECT seq, normalized_url, {fingerprint("coalesce(article_text, '')")} AS content_fp,
         {tkey} AS title_key, {rank('extraction_quality')} AS q, length(coalesce(article_text, '')) AS text_len
  FROM articles
)"""


def smart_dedup_ctes(mode: str = "best") -> str:
    """Window form of the three stages (s1, s2, s3) over ``keys``."""
    if mode == "best":
        s1 = """s1 AS (
  SELECT * FROM keys WHERE normalized_url IS NULL OR normalized_url = ''
  UNION ALL
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY q DESC, seq) AS rn
                   FROM keys WHERE normalized_url <> '') WHERE rn = 1
)"""
    else:
        s1 = """s1 AS (
  SELECT * FROM keys WHERE normalized_url IS NULL OR normalized_url = ''
  UNION ALL
  SELECT * EXCLUDE (prev) FROM (SELECT *, max(q) OVER (PARTITION BY normalized_url ORDER BY seq
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
                   FROM keys WHERE normalized_url <> '') WHERE prev IS NULL OR q > prev
)"""
    return s1 + """,
s2 AS (
  SELECT * FROM s1 WHERE content_fp IS NULL
  UNION ALL
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY content_fp ORDER BY q DESC, seq) AS rn
                   FROM s1 WHERE content_fp IS NOT NULL AND content_fp <> '') WHERE rn = 1
),
s3 AS (
  SELECT * FROM s2 WHERE title_key IS NULL OR title_key = ''
  UNION ALL
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title_key ORDER BY text_len DESC, seq) AS rn
                   FROM s2 WHERE title_key <> '') WHERE rn = 1
)"""


# ---------------------------------------------------------------- language / relevance

def _script_count(x: str, lo: int, hi: int) -> str:
    res = f"regexp_replace(coalesce({x}, ''), '[^\\x{{0900}}-\\x{{0D7F}}]', '', 'g')"
    return f"(length({res}) - length(regexp_replace({res}, '[\\x{{{lo:04X}}}-\\x{{{hi:04X}}}]', '', 'g')))"


def lang_first(x: str) -> str:
    from quern.functions.lang import SCRIPTS
    n = f"length(coalesce({x}, ''))"
    whens = " ".join(f"WHEN {_script_count(x, lo, hi)} > {n} * 0.15 THEN '{lang}'" for lang, lo, hi in SCRIPTS)
    return f"(CASE WHEN {n} < 50 THEN 'en' {whens} ELSE 'en' END)"


def lang_dominant(x: str) -> str:
    from quern.functions.lang import LATINISH, SCRIPTS
    n = f"length(coalesce({x}, ''))"
    counts = {lang: _script_count(x, lo, hi) for lang, lo, hi in SCRIPTS}
    top = f"greatest({', '.join(counts.values())})"
    pick = "CASE " + " ".join(f"WHEN {c} = {top} THEN '{lang}'" for lang, c in counts.items()) + " END"
    nonlat = f"length(regexp_replace(coalesce({x}, ''), {lit(LATINISH)}, '', 'g'))"
    return (f"(CASE WHEN {n} < 50 THEN 'en' WHEN {nonlat} > {n} * 0.15 AND {top} > {n} * 0.1 "
            f"THEN {pick} ELSE 'en' END)")


def hits(x: str, terms) -> str:
    return f"list_filter({lst(terms)}, lambda t: contains(lower(coalesce({x}, '')), lower(t)))"


def _count_present(x: str, phrases) -> str:
    return "(" + " + ".join(f"(CASE WHEN contains(lower(coalesce({x}, '')), {lit(p)}) THEN 1 ELSE 0 END)"
                           for p in phrases) + ")"


def relevant(x: str, terms, irrelevant=None, context=None) -> str:
    from quern.functions.relevance import CONTEXT, IRRELEVANT
    irrelevant = IRRELEVANT if irrelevant is None else irrelevant
    context = CONTEXT if context is None else context
    m = f"len({hits(x, terms)})"
    if not terms:
        return "false"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN false WHEN {m} = 0 THEN false "
            f"WHEN {_count_present(x, irrelevant)} > 2 THEN false WHEN {m} >= 2 THEN true "
            f"ELSE {_count_present(x, context)} >= 1 END)")


def relevance_reason(x: str, terms, irrelevant, context) -> str:
    m = f"len({hits(x, terms)})"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 'empty' WHEN {m} = 0 THEN 'none' "
            f"WHEN {_count_present(x, irrelevant)} > 2 THEN 'irrelevant' WHEN {m} >= 2 THEN 'multi' "
            f"WHEN {_count_present(x, context)} >= 1 THEN 'single_context' ELSE 'single_no_context' END)")
