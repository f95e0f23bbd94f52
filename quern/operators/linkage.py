"""E1 — final URLs back to the links of their file, as a cascade.

Candidates of a final are its own original, then the links of its file in
order; the first tier that has any match decides:

1. the same URL;
2. both at Google News;
3. the same domain: the best overlap of path segments, ties and no overlap
   to the earliest;
4. the same main domain;
5. one is a prefix of the other.

The own original is compared in the final's row. For all links, one lookup
table holds the earliest link of each (file, kind, key): its URL, Google, its
domain, its main domain; a domain's entry also holds its earliest link of
each path depth, which settles what a final and a link share if that is
only the empty segment before the first slash. One join brings a final its
keys' entries. Later tiers see only what is left: tier 3 the finals with a
link of their domain (a join on non-empty segments), tier 5 those without
any match, by one ordered pass (``prefix_partners``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import url as U
from quern.functions.text import py_strip
from quern.operators.common import materialize
from quern.session import shared_table, ship_package

GOOGLE = "news.google.com"
#: What the lookup is asked by.
KINDS = ("url", "google", "domain", "main")


def _parts(url: Column) -> Column:
    return F.array_distinct(F.split(F.lower(U.url_path(url)), "/"))


def _with_parts(df: DataFrame, url: str) -> DataFrame:
    """domain, main and parts of a URL column, each made once a row."""
    df = materialize(df, domain=U.extract_domain(F.col(url)), parts=_parts(F.col(url)))
    return df.withColumn("main", U.extract_main_domain(F.col("domain")))


def _keys(url: str) -> Column:
    """(kind, key) of each lookup that a URL takes part in."""
    google = F.when(F.instr(F.col(url), GOOGLE) > 0, F.lit(""))
    pairs = zip(KINDS, (F.col(url), google, F.col("domain"), F.col("main")))
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("key")) for k, c in pairs])
    return F.filter(keys, lambda x: x["key"].isNotNull())


def _similarity(common: Column, n: Column, m: Column) -> Column:
    return common / F.greatest(n, m, F.lit(1))


def _least(*options: Column) -> Column:
    """The least of the options that aren't null."""
    return F.array_min(F.array(*options))


def _lookup(links: DataFrame) -> DataFrame:
    """(grp, kind, key) → first (ord, cand), and by depth for domains: depths."""
    x = links.select("grp", "ord", "cand", F.when(F.array_contains("parts", ""), F.size("parts")).alias("n"), F.explode(_keys("cand")).alias("k"))
    depth = F.when(F.col("k.kind") == "domain", F.col("n"))
    x = x.groupBy("grp", F.col("k.kind").alias("kind"), F.col("k.key").alias("key"), depth.alias("n")).agg(F.min(F.struct("ord", "cand")).alias("w"))
    # a key has one entry, a domain one for each depth of its links' paths
    return x.groupBy("grp", "kind", "key").agg(F.min("w").alias("w"), F.collect_list(
        F.when(F.col("n").isNotNull(), F.struct("n", F.col("w.ord").alias("ord"), F.col("w.cand").alias("cand")))).alias("depths"))


def prefix_partners(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(grp, url, ord, cand): for each of ``asked`` (grp, url, distinct) the least ``ord`` of ``texts`` (grp, cand, ord)
    that is a prefix of the URL or has it as a prefix; both sides non-empty.

    Both are sorted as strings, where the extensions of a string follow it at
    once. One pass holds the stack of strings that the current one extends:
    each carries the least ord above it, and hands the least below it on when
    it is left. Strings open at a partition's start are prefixes of the first
    string there; those are looked up and stand at the partition's head, so a
    pass never needs its neighbour. Work is linear in the strings' bytes.
    """
    spark = texts.sparkSession
    ship_package(spark)
    both = texts.select("grp", F.col("cand").alias("s"), F.col("ord").cast("bigint").alias("ord"), F.lit(False).alias("ask")).unionByName(
        asked.select("grp", F.col("url").alias("s"), F.lit(None).cast("bigint").alias("ord"), F.lit(True).alias("ask"))).where("s <> ''")
    # One row a string: its least ord, and whether it is asked for.
    both = both.groupBy("grp", "s").agg(F.min("ord").alias("ord"), F.max("ask").alias("ask"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = shared_table(both.repartitionByRange(parts, "grp", "s").withColumn("part", F.spark_partition_id()), "sorted-urls")
    heads = rows.groupBy("part").agg(F.min(F.struct("grp", "s")).alias("h"))
    open_ = heads.select(F.col("part").alias("to"), F.col("h.grp").alias("grp"), F.col("h.s").alias("head"),
                         F.explode(F.transform(F.sequence(F.lit(1), F.length("h.s")), lambda i: F.substring("h.s", 1, i))).alias("s"))
    # The prefixes of one string a partition: their number is bounded by the partitions, not by the data.
    carried = rows.join(F.broadcast(open_.where("s <> head")), ["grp", "s"]).where("part < to").select(
        "grp", "s", "ord", "ask", F.col("to").alias("part"))
    dealt = rows.select("grp", "s", "ord", "ask", "part").unionByName(carried).repartition(parts, "part").sortWithinPartitions("part", "grp", "s")

    def run(frames):
        stack: list[list] = []      # [string, asked for, least ord above or here, least ord below]
        at, out = None, []

        def leave():
            s, ask, above, below = stack.pop()
            if ask and min(above, below) < NONE:
                out.append((at[1], s, min(above, below)))
            if stack:
                stack[-1][3] = min(stack[-1][3], below)

        for f in frames:
            for part, grp, s, o, ask in zip(f["part"], f["grp"], f["s"], f["ord"], f["ask"]):
                if at != (part, grp):
                    while stack:
                        leave()
                    at = (part, grp)
                while stack and not s.startswith(stack[-1][0]):
                    leave()
                here = NONE if pd.isna(o) else int(o)
                stack.append([s, ask, min(here, stack[-1][2] if stack else NONE), here])
            if out:
                yield pd.DataFrame(out, columns=["grp", "url", "ord"])
                out = []
        while stack:
            leave()
        if out:
            yield pd.DataFrame(out, columns=["grp", "url", "ord"])

    grp_type = dict(texts.dtypes)["grp"]
    best = dealt.mapInPandas(run, f"grp {grp_type}, url string, ord bigint").groupBy("grp", "url").agg(F.min("ord").alias("ord"))
    return best.join(texts.select("grp", F.col("ord").cast("bigint").alias("ord"), "cand"), ["grp", "ord"])


NONE = 1 << 62


def link_final_to_original(finals: DataFrame, links: DataFrame, group: str = "csv", seq: str = "seq", link_seq: str = "seq") -> DataFrame:
    """``finals`` (group, seq, original_url, final_url) with ``matched_link`` and ``match_tier``.

    ``links``: (group, seq, Link). No match, or an empty or null final: the own original, tier 0.
    """
    lk = links.select(F.col(group).alias("grp"), F.col(link_seq).alias("ord"), py_strip(F.col("Link")).alias("cand")).where("cand IS NOT NULL")
    lk = _with_parts(lk, "cand")
    table = shared_table(_lookup(lk), "link-lookup")
    fin = finals.select(F.col(group).alias("grp"), F.col(seq).alias("fseq"), "original_url", "final_url")
    fin = materialize(fin, o_domain=U.extract_domain(F.col("original_url")), o_parts=_parts(F.col("original_url")))
    fin = _with_parts(fin, "final_url").withColumn("o_main", U.extract_main_domain(F.col("o_domain")))
    # One row a key; the URL's row carries the final, the others its name only. A null final keeps one row.
    keys = F.concat(_keys("final_url"), F.when(F.col("final_url").isNull(), F.array(F.struct(F.lit("url").alias("kind"), F.lit(None).cast("string").alias("key"))))
                    .otherwise(F.array().cast("array<struct<kind:string,key:string>>")))
    x = fin.select("grp", "fseq", F.struct("original_url", "final_url", "domain", "parts", "main", "o_domain", "o_parts", "o_main").alias("f"),
                   F.explode(keys).alias("k"))
    x = x.select("grp", "fseq", F.when(F.col("k.kind") == "url", F.col("f")).alias("f"), F.col("k.kind").alias("kind"), F.col("k.key").alias("key"))
    x = x.join(table, ["grp", "kind", "key"], "left").groupBy("grp", "fseq").agg(
        F.first("f", True).alias("f"), *[F.first(F.when(F.col("kind") == k, F.col("w")), True).alias(f"{k}_w") for k in KINDS],
        F.first(F.when(F.col("kind") == "domain", F.col("depths")), True).alias("depths"))
    x = x.select("grp", "fseq", "f.*", *[f"{k}_w" for k in KINDS], "depths")

    n, own = F.size("parts"), F.col("original_url")
    some = F.col("final_url").isNotNull() & (F.col("final_url") != "")
    google = lambda c: F.instr(F.col(c), GOOGLE) > 0
    t1 = F.when(F.col("final_url") == own, own).otherwise(F.col("url_w.cand"))
    t2 = F.when(google("final_url"), F.when(google("original_url"), own).otherwise(F.col("google_w.cand")))
    # Tier 3 as far as a row knows: its own original, the domain's first link, and for each depth the first
    # link with the empty segment (a lower bound where more is shared; the join below knows better).
    best = lambda sim, o, c: F.struct((-sim.cast("double") + 0.0).alias("neg"), o.cast("bigint").alias("ord"), c.alias("cand"))
    mine = F.when(F.col("o_domain") == F.col("domain"), best(
        _similarity(F.size(F.array_intersect("parts", "o_parts")), n, F.size("o_parts")), F.lit(-1), own))
    zero = F.when(F.col("domain_w").isNotNull(), best(F.lit(0.0), F.col("domain_w.ord"), F.col("domain_w.cand")))
    bare = F.array_min(F.when(F.array_contains("parts", ""), F.transform("depths", lambda d: best(_similarity(F.lit(1), n, d["n"]), d["ord"], d["cand"]))))
    x = x.select("grp", "fseq", "original_url", "final_url", "domain", "parts", some.alias("some"), t1.alias("t1"), t2.alias("t2"),
                 _least(mine, zero, bare).alias("t3"), F.col("domain_w").isNotNull().alias("linked"),
                 F.when(F.col("o_main") == F.col("main"), own).otherwise(F.col("main_w.cand")).alias("t4"))
    x = shared_table(x, "looked-up")

    # Tier 3: finals left, with a link of their domain, by the segments they share.
    left = x.where("some AND t1 IS NULL AND t2 IS NULL AND linked")
    fpart = left.select("grp", "fseq", "domain", F.size("parts").alias("fn"), F.array_contains("parts", "").alias("fe"), F.explode("parts").alias("part")).where("part <> ''")
    first = table.where("kind = 'url'").select("grp", F.col("w.ord").alias("ord"), F.col("w.cand").alias("cand"))
    first = _with_parts(first, "cand")
    lpart = first.select("grp", "domain", "ord", "cand", F.size("parts").alias("ln"), F.array_contains("parts", "").alias("le"), F.explode("parts").alias("part")).where("part <> ''")
    shared = fpart.join(lpart, ["grp", "domain", "part"]).repartition("grp", "fseq")  # both counts below keep this deal
    shared = shared.groupBy("grp", "fseq", "cand").agg(
        F.first("ord").alias("ord"), _similarity(F.count("*") + F.first((F.col("fe") & F.col("le")).cast("int")), F.first("fn"), F.first("ln")).alias("sim"))
    shared = shared.groupBy("grp", "fseq").agg(F.min(best(F.col("sim"), F.col("ord"), F.col("cand"))).alias("t3s"))
    x = x.join(shared, ["grp", "fseq"], "left").withColumn("t3", _least(F.col("t3"), F.col("t3s"))["cand"])

    # Tier 5: what has no match so far.
    x = x.select("grp", "fseq", "original_url", "final_url", "some", "t1", "t2", "t3", "t4")
    bare_ = x.where("some AND t1 IS NULL AND t2 IS NULL AND t3 IS NULL AND t4 IS NULL")
    either = F.col("final_url").startswith(F.col("original_url")) | F.col("original_url").startswith(F.col("final_url"))
    asked = bare_.where(~F.coalesce(either, F.lit(False))).select("grp", F.col("final_url").alias("url")).distinct()
    found = prefix_partners(first.select("grp", "cand", "ord"), asked).select("grp", F.col("url").alias("final_url"), F.col("cand").alias("t5"))
    x = x.join(found, ["grp", "final_url"], "left").withColumn("t5", F.when(either, F.col("original_url")).otherwise(F.col("t5")))
    tiers = ["t1", "t2", "t3", "t4", "t5"]
    tier = F.coalesce(*[F.when(F.col("some") & F.col(t).isNotNull(), i + 1) for i, t in enumerate(tiers)], F.lit(0))
    return x.select(F.col("grp").alias(group), F.col("fseq").alias(seq), "original_url", "final_url",
                    F.when(F.col("some"), F.coalesce(*tiers, "original_url")).otherwise(F.col("original_url")).alias("matched_link"),
                    tier.alias("match_tier"))
