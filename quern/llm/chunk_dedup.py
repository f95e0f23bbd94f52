"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

1. A text is cut where its own last four characters say so (a cut point
   depends on content, not on offset), with a least and a largest chunk.
2. Chunks are deduplicated on their bytes: the dictionary of distinct
   (identifier, chunk) rows moves each distinct chunk once. Two chunks
   with one identifier would show there; such identifiers get an ordinal,
   so an identifier always stands for one chunk (verified, not assumed).
3. A document becomes its ordered list of identifiers. Lists, not texts,
   are grouped and joined, so long documents never move again.

Equal texts have equal cuts, hence equal lists; equal lists of verified
identifiers concatenate to equal texts. The result is exact.

Nulls: a null text counts as empty (an empty recipe). A null doc_id never
wins against another id; a group of null ids only keeps one of its rows.
Rows equal in text and doc_id are ties: one of them stays. An empty table
gives an empty result. Extra columns are ignored by ``groups`` and carried
by ``keep_last``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quern.llm.common import free_name, shared_table

#: Least and largest chunk in characters, and the cut rule: one character of
#: each class in a row. Over letters each class holds about a third.
MIN_CHUNK, MAX_CHUNK = 512, 8192
CUT = (r"[ aefhlpsuz0369]", r"[ bdgimrtwx1478éü]", r"[acehnoqty258,.]", r"[ dinorsv\n]", r"[ adeikoty.]")


def chunks(text: Column, lo: int = MIN_CHUNK, hi: int = MAX_CHUNK, cut: tuple[str, ...] = CUT) -> Column:
    """The text as an array of chunks, in order, nothing lost."""
    look = "".join(cut)
    rx = rf"(?s).{{{lo},{hi}}}?(?<={look})|.{{{hi}}}|.+"
    return F.regexp_extract_all(text, F.lit(rx), F.lit(0))


def identifier(chunk: Column) -> Column:
    """128 bits and the length: the name of a chunk until it is verified."""
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(F.lit(7), chunk).alias("b"),
                    F.length(chunk).alias("n"))


def dictionary(texts: DataFrame, ident=identifier) -> DataFrame:
    """Distinct (id, chunk) of a frame with the column ``_text``."""
    one = texts.select(F.explode(chunks(F.col("_text"))).alias("chunk"))
    return one.select(ident(F.col("chunk")).alias("id"), "chunk").distinct()


def clashes(entries: DataFrame) -> DataFrame:
    """Identifiers that stand for several chunks: (id, chunk, ord)."""
    many = entries.groupBy("id").count().filter("count > 1").select("id")
    w = Window.partitionBy("id").orderBy("chunk")
    return entries.join(many, "id").withColumn("ord", F.row_number().over(w))


def recipes(df: DataFrame, ident=identifier, text_col: str = "text") -> DataFrame:
    """``df`` plus ``_recipe``: the ordered verified identifiers of its text.

    Checking the dictionary for clashes is a job of its own; where there
    are none (as always with 128-bit names) a recipe needs no shuffle.
    """
    texts = df.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    clash = clashes(dictionary(texts.select("_text"), ident))
    named = F.transform(chunks(F.col("_text")), lambda c: ident(c))
    if clash.isEmpty():
        return texts.withColumn("_recipe", named).drop("_text")
    # Only texts that hold a clashing identifier are taken apart again.
    key = F.struct(F.sha2("_text", 256), F.sha2(F.reverse("_text"), 256))
    parts = texts.select("_text").distinct().select(key.alias("_key"), F.posexplode(chunks(F.col("_text"))).alias("pos", "chunk"))
    ords = (parts.withColumn("id", ident(F.col("chunk"))).join(clash, ["id", "chunk"])
            .groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("pos", "ord"))).alias("_ords")))
    none = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<int>"))
    out = texts.withColumn("_key", key).join(ords, "_key", "left").withColumn("_ords", F.coalesce("_ords", none))
    settled = F.transform(chunks(F.col("_text")), lambda c, i: F.struct(
        ident(c).alias("id"), F.coalesce(F.try_element_at(F.col("_ords"), i), F.lit(0)).alias("ord")))
    return out.withColumn("_recipe", settled).drop("_text", "_key", "_ords")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ident=identifier) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Rows equal in recipe and id are counted before anything is joined, so a
    group of any size is pre-aggregated in the map tasks.
    """
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    r = recipes(d, ident).select("doc_id", "_recipe", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    rows = r.groupBy("_recipe", "doc_id", "text_sha256").agg(F.count("*").alias("_copies"))
    rows = shared_table(rows, "recipes")
    best = rows.groupBy("_recipe").agg(F.max("doc_id").alias("_best"), F.sum("_copies").alias("_size"))
    # Only groups of several rows are joined, from a table, so that the join can split a large group.
    best = shared_table(best.filter("_size > 1"), "groups")
    out = rows.join(best, "_recipe", "left").select(
        "*", F.coalesce("_size", "_copies").alias("group_size"),
        F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_best")).alias("keep_id"))
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
                      "text_sha256", F.size("_recipe").alias("n_chunks"))


def keep_last(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole rows of ``df`` that stay: of equal texts, the one with the largest id."""
    stay = (groups(df, id_col, text_col).filter("kept")
            .select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_sha")))
    sha = free_name(df, "_sha2")
    hit = df.withColumn(sha, F.sha2(F.coalesce(df[text_col], F.lit("")), 256))
    keep, same = free_name(hit, "_keep"), free_name(hit, "_sha")
    stay = stay.toDF(keep, same)
    hit = hit.join(stay, hit[id_col].eqNullSafe(stay[keep]) & (hit[sha] == stay[same]), "left_semi")
    return hit.dropDuplicates([id_col, sha]).drop(sha)


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
