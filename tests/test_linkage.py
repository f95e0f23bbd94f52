"""The linkage cascade and its prefix pass against brute force."""

import random
from urllib.parse import urlparse

from quern.operators import linkage as L


def test_prefix_partners_equal_brute_force_over_many_partitions(spark):
    """Strings that are prefixes of very many others, over partition bounds and files."""
    rng = random.Random(4)
    texts, asked = [], set()
    for grp in (1, 2, 3):
        pool = ["a" * n for n in range(1, 8)] + ["".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(250)]
        texts += [(grp, s, rng.randrange(10 ** 6)) for s in set(rng.sample(pool, 120))]
        asked |= {(grp, s) for s in rng.sample(pool, 120)}
    texts.append((9, "only", 5))
    asked |= {(8, "nobody"), (9, "only.more"), (9, "o"), (9, "x")}
    want = {}
    for grp, url in asked:
        near = [(o, c) for g, c, o in texts if g == grp and (c.startswith(url) or url.startswith(c))]
        if near:
            want[grp, url] = min(near)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = L.prefix_partners(spark.createDataFrame(texts, "grp int, cand string, ord long"),
                                spark.createDataFrame(sorted(asked), "grp int, url string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {(r["grp"], r["url"]): (r["ord"], r["cand"]) for r in got} == want and len(got) == len(want)


def _domain(url):
    d = urlparse(url).netloc.lower()
    return d[4:] if d.startswith("www.") else d


def _main(d):
    return ".".join(d.split(".")[-2:]) if d else ""


def match(final, original, links):
    """Row-by-row model: (link, tier)."""
    if not final:
        return original, 0
    cands = [original, *links]
    if final in cands:
        return final, 1
    if L.GOOGLE in final:
        for c in cands:
            if L.GOOGLE in c:
                return c, 2
    same = [c for c in cands if _domain(c) == _domain(final)]
    if same:
        best, score = same[0], 0
        parts = set(urlparse(final).path.lower().split("/"))
        for c in same:
            own = set(urlparse(c).path.lower().split("/"))
            s = len(parts & own) / max(len(parts), len(own), 1)
            if s > score:
                best, score = c, s
        return best, 3
    for c in cands:
        if _main(_domain(c)) == _main(_domain(final)):
            return c, 4
    for c in cands:
        if final.startswith(c) or c.startswith(final):
            return c, 5
    return original, 0


def test_cascade_equals_the_loop(spark):
    rng = random.Random(9)
    hosts = ["a.example.com", "www.a.example.com", "b.example.com", "example.org", "m.example.org", "news.google.com", "x.net", "Y.Example.IN"]

    def url():
        return "https://" + rng.choice(hosts) + rng.choice(["", "/"]) + "/".join(rng.choices(["news", "2024", "x", "Y", "", "story"], k=rng.randint(0, 4)))

    finals, links, files = [], [], {}
    for csv in range(6):
        files[csv] = [rng.choice([url(), url(), "https://x", "http"]) for _ in range(rng.choice([0, 3, 25]))]
        links += [(csv, i * 2, f" {u} " if i % 4 == 0 else u) for i, u in enumerate(files[csv])] + [(csv, 99, None)]
        for i in range(80):
            final = rng.choice([url(), rng.choice(files[csv] or [""]), "https://x.ne", "https://unknown.host/p", "https://m.example", "", None])
            finals.append((csv, i, rng.choice([url(), "https://nowhere.info/a"]), final))
    got = L.link_final_to_original(spark.createDataFrame(finals, "csv int, seq int, original_url string, final_url string"),
                                   spark.createDataFrame(links, "csv int, seq int, Link string")).collect()
    want = {(c, s): match(f, o, files[c]) for c, s, o, f in finals}
    assert {(r["csv"], r["seq"]): (r["matched_link"], r["match_tier"]) for r in got} == want
    assert len(got) == len(finals) and {t for _, t in want.values()} == {0, 1, 2, 3, 4, 5}
