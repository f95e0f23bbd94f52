"""URL filter: rules first, gradient-boosted trees on lexical features else.

A rule names a host and a path: it fits that host and its subdomains where
the URL's path starts with the rule's, and the longest rule that fits
decides. URLs that a rule decides, and URLs on hosts with a word of the
block list, are the labelled ones; boosted trees are fitted on a bounded
sample of them (``TRAIN_ROWS``) and judge the URLs without a rule. The
sample holds both kinds wherever the table does (``sample_sizes``).

Features, all DataFrame expressions: lengths of URL, host and path, depth,
host labels, longest label, digit ratio, hyphens, letter entropy of the
host, parameters and their length, file suffix, fragment, scheme, and
suffix statistics over the whole table (share of the host's last label and
of its last two labels among all URLs).

Nulls: a null URL, or one without ``://``, has an empty host and path, fits
no rule, and is judged like any other. Without labelled URLs of both kinds
nothing can be fitted and the verdict is ``allow`` (or the only kind).
Repeated rows get the same verdict. Empty tables give empty results. Extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed rules of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

#: Host words that label a URL as unwanted for training.
BLOCK_WORDS = ("adult", "casino", "bets", "pills", "spam", "ads-track", "malware", "phish")

#: Labelled URLs the trees are fitted on, at most.
TRAIN_ROWS = 20_000
#: Of the rarer kind at least so many of them, if there are.
LEAST_OF_KIND = 1_000
TREES, DEPTH = 12, 4

FEATURES = ("url_len", "host_len", "path_len", "depth", "labels", "longest_label", "digits", "hyphens", "entropy", "params",
            "query_len", "file", "fragment", "https", "suffix_share", "domain_share")


def split_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` plus host and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    after = F.substr(rest, F.length(host) + 1)
    return df.withColumn("host", F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn(
        "path", F.regexp_extract(after, r"(?s)^[^?#]*", 0))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters a-z, 0-9, dot and hyphen."""
    n = F.greatest(F.length(text), F.lit(1))
    total = F.lit(0.0)
    for c in "abcdefghijklmnopqrstuvwxyz0123456789.-":
        p = (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))) / n
        total = total - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0))
    return total


def lexical(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` (with host and path) plus the feature columns."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = F.col("host"), F.col("path")
    label = F.split(host, r"\.")
    count = lambda rx, x: F.regexp_count(x, F.lit(rx)).cast("double")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    x = df.withColumns({
        "suffix": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2),
        "url_len": F.length(url).cast("double"), "host_len": F.length(host).cast("double"),
        "path_len": F.length(path).cast("double"), "depth": count("/[^/]", path), "labels": F.size(label).cast("double"),
        "longest_label": F.array_max(F.transform(label, F.length)).cast("double"),
        "digits": count("[0-9]", url) / F.greatest(F.length(url), F.lit(1)), "hyphens": count("-", host),
        "entropy": _entropy(host), "params": count("[^&]+", query), "query_len": F.length(query).cast("double"),
        "file": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("double"), "fragment": url.contains("#").cast("double"),
        "https": F.startswith(url, F.lit("https://")).cast("double")})
    # Suffix statistics: counted over all rows, one row a suffix, map-side combined.
    for key in ("suffix", "domain"):
        n = x.groupBy(F.col(key).alias(f"_{key}")).agg(F.count("*").alias("_n"))
        total = x.agg(F.count("*").alias("_all"))
        share = n.withColumn("_all", total.select("_all").scalar()).select(
            f"_{key}", F.log1p(F.col("_n") / F.col("_all")).alias(f"{key}_share"))
        x = x.join(share, F.col(key) == F.col(f"_{key}")).drop(f"_{key}")
    return x


def sample_sizes(count: dict[float, int], train_rows: int = TRAIN_ROWS) -> dict[float, int]:
    """How many labelled URLs of each kind the trees are fitted on: all, or ``train_rows`` in
    the kinds' shares, of the rarer one at least ``LEAST_OF_KIND`` (or all, or half of the sample)."""
    total = sum(count.values())
    if total <= train_rows:
        return dict(count)
    out, left = {}, train_rows
    for kind in sorted(count, key=lambda c: (count[c], c))[:-1]:
        out[kind] = max(train_rows * count[kind] // total, min(count[kind], LEAST_OF_KIND, train_rows // 2))
        left -= out[kind]
    return out | {kind: left for kind in count if kind not in out}


def judge(df: DataFrame, rules=RULES, block_words=BLOCK_WORDS, train_rows: int = TRAIN_ROWS, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score (probability of ``block``; of a rule's verdict 0 or 1)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    x = split_url(df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")))
    x = x.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    listed = F.lit(False)
    for w in block_words:
        listed = listed | F.col("host").contains(w)
    label = (F.when(listed, 1.0).when(F.col("_rule.verdict") == "block", 1.0).when(F.col("_rule.verdict") == "allow", 0.0))
    x = x.withColumn("label", label)
    kinds = sample_sizes({r["label"]: r["count"] for r in x.filter("label IS NOT NULL").groupBy("label").count().collect()}, train_rows)
    x = lexical(x)
    x = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x)
    # The sample: of each kind the labelled URLs first in the order of a hash.
    if len(kinds) == 2:
        parts = [x.filter(F.col("label") == kind).orderBy(F.xxhash64("url", "page_id"), "url").limit(n).select("label", "features")
                 for kind, n in sorted(kinds.items())]
        train = parts[0].unionByName(parts[1])
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=5, stepSize=0.3).fit(train.coalesce(1))
        x = model.transform(x).withColumn("_p", vector_to_array("probability")[1])
    else:
        x = x.withColumn("_p", F.lit(1.0 if set(kinds) == {1.0} else 0.0))
    own = F.when(F.col("_p") > 0.5, "block").otherwise("allow")
    return x.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                    F.coalesce("_rule.verdict", own).alias("verdict"),
                    F.when(F.col("_rule").isNotNull(), (F.col("_rule.verdict") == "block").cast("double")).otherwise(F.col("_p")).alias("score"))
