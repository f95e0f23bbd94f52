"""De-duplication operators (G1–G6) and the staged ``smart_dedup``.

The reference walks the rows in input order and keeps one dict per stage.
Those loop rules are order statistics per key, so every stage here is a
single hash aggregate:

* best-of-group (G2 best, G3, G4): the survivor of a key is
  ``min(struct(rank, seq, payload…))`` — Spark computes it map-side first
  (partial aggregation), so a key holding a third of all rows is reduced
  on every mapper before the shuffle and never lands whole in one task.
  The payload rides inside the struct, so no join back to the input is
  needed between stages;
* G2 faithful (the reference's literal stage 1: a better copy is appended
  but the older copy is not removed): a row survives iff it is strictly
  better than every earlier row of its key.  With three grades that is
  "the first row of its grade, earlier than the first row of every higher
  grade" — three ``min`` aggregates per key and ≤ 3 survivors.

Rows without a key pass every stage; they get a unique private key
(``\\x01`` + seq) instead of a separate branch, so the input is read once.
The stages run on a narrow key frame; the article text is never shuffled
by the dedup itself.  Each stage also sums its input counts, which gives
the F8 funnel from the final frame without recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.common import materialize
from quern.operators.ranking import rank_in_group

from quern.functions import quality as Q
from quern.functions import text as T
from quern.functions import url as U

PRIVATE = "\u0001"


def _has_key(c: str) -> F.Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def _group_key(key: str, seq: str = "seq") -> F.Column:
    return F.when(_has_key(key), F.col(key)).otherwise(F.concat(F.lit(PRIVATE), F.col(seq).cast("string")))


def keep_best(df: DataFrame, key: str, order: list[F.Column], count_as: str,
              seq: str = "seq", sums: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``key``: the first under ``order`` then ``seq``.

    Keyless rows pass.  ``count_as`` receives the number of input rows of
    the survivor's group; columns in ``sums`` are summed over the group
    (earlier stage counts), every other column is the survivor's own.
    """
    payload = [c for c in df.columns if c != seq and c not in sums]
    rec = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.col(seq).alias(seq),
                   *[F.col(c) for c in payload])
    g = df.groupBy(_group_key(key, seq).alias("_k")).agg(
        F.min(rec).alias("_w"), F.count(F.lit(1)).alias(count_as), *[F.sum(c).alias(c) for c in sums])
    return g.select(F.col(f"_w.{seq}").alias(seq), *[F.col(f"_w.{c}").alias(c) for c in payload],
                    *[F.col(c) for c in sums], F.col(count_as))


def keep_faithful(df: DataFrame, key: str, rank: str = "q", count_as: str = "n_in",
                  seq: str = "seq") -> DataFrame:
    """G2 faithful: rows strictly better than every earlier row of their key."""
    payload = [c for c in df.columns if c != seq]
    rec = F.struct(F.col(seq).alias(seq), *[F.col(c) for c in payload])
    g = df.groupBy(_group_key(key, seq).alias("_k")).agg(
        *[F.min(F.when(F.col(rank) == r, rec)).alias(f"f{r}") for r in (1, 2, 3)],
        F.count(F.lit(1)).alias(count_as))
    big = F.lit(2 ** 62).cast("bigint")

    def first(r):
        return F.coalesce(F.col(f"f{r}.{seq}"), big)

    cand = F.array(
        F.col("f3"),
        F.when(first(2) < first(3), F.col("f2")),
        F.when(first(1) < F.least(first(2), first(3)), F.col("f1")),
    )
    lead = F.least(first(1), first(2), first(3))
    out = g.select(F.explode(cand).alias("_w"), F.col(count_as), lead.alias("_lead")).where(F.col("_w").isNotNull())
    # the group's input count is carried by its earliest survivor only
    return out.select(F.col(f"_w.{seq}").alias(seq), *[F.col(f"_w.{c}").alias(c) for c in payload],
                      F.when(F.col(f"_w.{seq}") == F.col("_lead"), F.col(count_as))
                      .otherwise(F.lit(0).cast("bigint")).alias(count_as))


def dedup_keys(articles: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Narrow projection with every dedup key; the grade, which is a key and may be carried, is made once a row."""
    articles = materialize(articles, _grade=F.col("extraction_quality"))
    text = F.coalesce(F.col("article_text"), F.lit(""))
    has_title = T.py_strip(F.lower(F.coalesce(F.col("title"), F.lit("")))) != ""
    domain = U.extract_domain("final_url")
    tkey = F.when((domain != "") & has_title, F.concat(domain, F.lit("::"), T.title_key("title")))
    cols = [F.col("seq"),
            (F.col("normalized_url") if "normalized_url" in articles.columns
             else U.normalize_url("final_url")).alias("normalized_url"),
            T.content_fingerprint(text).alias("content_fp"),
            tkey.alias("title_key"),
            Q.quality_rank("_grade").alias("q"),
            F.length(text).alias("text_len")]
    taken = {"seq", "normalized_url", "content_fp", "title_key", "q", "text_len"}
    cols += [F.col("_grade" if c == "extraction_quality" else c).alias(c) for c in (carry or []) if c not in taken]
    return articles.select(*cols)


def _url_stage(keys: DataFrame, mode: str) -> DataFrame:
    if mode == "best":
        return keep_best(keys, "normalized_url", [-F.col("q")], "n_in")
    if mode == "faithful":
        return keep_faithful(keys, "normalized_url", "q", "n_in")
    raise ValueError(f"mode must be 'best' or 'faithful', not {mode!r}")


def dedup_chain(keys: DataFrame, mode: str = "best") -> DataFrame:
    """G5 on the key frame: survivors of URL → content → title.

    Per survivor, ``n_in`` / ``n_url`` / ``n_content`` count the input
    rows, stage-1 survivors and stage-2 survivors it stands for, so the
    funnel is a sum over the output.
    """
    s1 = _url_stage(keys, mode)
    s2 = keep_best(s1, "content_fp", [-F.col("q")], "n_url", sums=("n_in",))
    return keep_best(s2, "title_key", [-F.col("text_len")], "n_content", sums=("n_in", "n_url"))


def smart_dedup(articles: DataFrame, mode: str = "best", carry: list[str] | None = None,
                chain: DataFrame | None = None) -> DataFrame:
    """G5 — URL → content → title stages.

    ``carry=None`` returns the surviving article rows (one semi-join of the
    wide input on ``seq``); with ``carry`` it returns the narrow survivor
    frame plus those columns and never touches the text again.  ``chain`` is
    the ``dedup_chain`` of these articles, where the caller has it already.
    """
    if chain is None:
        chain = dedup_chain(dedup_keys(articles, carry), mode)
    if carry is not None:
        return chain
    return articles.join(chain.select("seq"), "seq", "left_semi")


def dedup_stage(articles: DataFrame, stage: str, mode: str = "best",
                carry: list[str] | None = None) -> DataFrame:
    """One stage on its own (G2 / G3 / G4) over the whole input."""
    keys = dedup_keys(articles, carry)
    if stage == "url":
        return _url_stage(keys, mode)
    if stage == "content":
        return keep_best(keys, "content_fp", [-F.col("q")], "n_in")
    if stage == "title":
        return keep_best(keys, "title_key", [-F.col("text_len")], "n_in")
    raise ValueError(stage)


def dedup_first(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """G1 — drop repeated ``key`` values; the earliest row (by ``seq``) wins."""
    return keep_best(df, key, [], "n_copies", seq).drop("n_copies")


def batch_dedup(df: DataFrame, group: str, url: str, n: int = 3, seq: str = "seq",
                pos: str | None = None) -> DataFrame:
    """G6 — rows are cut into batches of ``n`` in order within ``group``; a
    repeated ``lower(strip(url))`` inside one batch is dropped.

    ``pos`` (0-based position inside the group) makes the batch a pure
    projection; without it the position comes from ``rank_in_group``,
    which never sorts a whole group in one task.
    """
    if pos:
        b = df.withColumn("_pos", F.col(pos))
    else:
        b = rank_in_group(df, group, seq, "_pos")
    b = (b.withColumn("_batch", F.floor(F.col("_pos") / n))
         .withColumn("_bk", F.concat_ws("\u0001", F.col(group).cast("string"), F.col("_batch").cast("string"),
                                        F.lower(T.py_strip(F.col(url))))))
    return keep_best(b, "_bk", [], "_n", seq).drop("_pos", "_batch", "_bk", "_n")
