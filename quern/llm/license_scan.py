"""Licence scan by diagonal voting.

All rolling word k-gram hashes of the documents are joined to the positions
of the same k-grams in the templates. A hit votes for its diagonal, the
place in the document where the template would begin (document position
minus template position). Diagonals with votes are aggregated; neighbouring
ones (small insertions and deletions) are merged into one candidate span;
candidates are verified on the words themselves.

Two kinds of templates: a *phrase* must stand whole and exact (one diagonal
with all its votes); a *text* must be found to a share of its words.

Words: runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.

Nulls: a null text counts as empty (no words, no label). Rows equal in id
and text give equal results. Ids may be null or repeated. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import ALNUM_WORD, LOWER, Words, gram_hash, map_arrow, pieces_of, shared_table

K = 3
#: Diagonals at most this many words apart belong to one occurrence.
SLACK = 4
#: Votes a candidate needs, as a share of the template's k-grams, and the
#: likeness its words need when verified.
LEAST_VOTES, LEAST_LIKENESS = 0.4, 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False


#: Fixed phrases of the contract.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

#: Opening paragraphs and notices of common licences (fixed texts).
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
             "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
             "copies of the Software"),
    Template("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License "
             "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
             "See the License for the specific language governing permissions and limitations under the License."),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
             "in compliance with the License. You may obtain a copy of the License at"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
             "General Public License as published by the Free Software Foundation"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def words_of(text: str) -> list[str]:
    w = Words([text.encode("utf-8", "replace").translate(LOWER)], ALNUM_WORD)
    return [w.word(i).decode() for i in range(len(w))]


def _template_grams(templates, k: int) -> list[tuple[int, int, int]]:
    """(gram, template, position) of all templates: a fixed table of a few hundred rows."""
    out = []
    for i, t in enumerate(templates):
        w = Words([t.text.encode().translate(LOWER)], ALNUM_WORD)
        if len(w) < k:
            raise ValueError(f"template {t.text!r} has fewer than {k} words")
        out += [(int(g), i, p) for p, g in enumerate(gram_hash(w.hash, k).view(np.int64))]
    return out


def _grams(k: int):
    def make():
        def step(b: pa.RecordBatch):
            texts = b.column("text").to_pylist()
            for lo, hi in pieces_of(np.array([len(t or "") + 1 for t in texts]), 4_000_000):
                w = Words([(t or "").encode("utf-8", "replace").translate(LOWER) for t in texts[lo:hi]], ALNUM_WORD)
                g = gram_hash(w.hash, k).view(np.int64)
                n = np.maximum(w.count - k + 1, 0)
                # Grams that begin within a text's last k-1 words cross into the next text.
                begin = w.first[:-1]
                at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("k")[lo:hi], b.column("d")[lo:hi], pa.ListArray.from_arrays(pa.array(offsets), pa.array(g[at]))],
                    names=["k", "d", "grams"])
        return step
    return make


def _with_words(grams: list[int], k: int):
    """Word counts of all texts, and the text itself where any template gram stands in it."""
    def make():
        wanted = np.unique(np.array(grams, np.int64))

        def step(b: pa.RecordBatch):
            texts = b.column("text").to_pylist()
            for lo, hi in pieces_of(np.array([len(t or "") + 1 for t in texts]), 4_000_000):
                w = Words([(t or "").encode("utf-8", "replace").translate(LOWER) for t in texts[lo:hi]], ALNUM_WORD)
                g = gram_hash(w.hash, k).view(np.int64)
                near = np.searchsorted(wanted, g)
                at = np.flatnonzero(wanted[np.minimum(near, len(wanted) - 1)] == g)
                hit = set((np.searchsorted(w.first, at, "right") - 1).tolist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("k")[lo:hi], b.column("d")[lo:hi], b.column("doc_id")[lo:hi], pa.array(w.count.astype(np.int64)),
                     pa.array([t if i in hit else None for i, t in enumerate(texts[lo:hi])], pa.string())],
                    names=["k", "d", "doc_id", "n_words", "text"])
        return step
    return make


def _verify(templates):
    def make():
        wanted = [words_of(t.text) for t in templates]

        def step(b: pa.RecordBatch):
            out = []
            for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                words, found = words_of(text or ""), []
                for s in spans:
                    t, want = templates[s["template"]], wanted[s["template"]]
                    if t.phrase:
                        like = float(words[s["lo"]:s["hi"]] == want)
                    else:
                        like = SequenceMatcher(None, words[max(0, s["lo"]):s["hi"]], want, autojunk=False).ratio()
                    if like >= (1.0 if t.phrase else LEAST_LIKENESS):
                        found.append({"label": t.label, "phrase": t.phrase, "first": max(0, s["lo"]), "end": s["hi"], "likeness": like})
                out.append(found)
            kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("first", pa.int64()),
                                       ("end", pa.int64()), ("likeness", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("d"), pa.array(out, kind)], names=["k", "d", "spans"])
        return step
    return make


SPANS = "array<struct<label:string,phrase:boolean,first:bigint,end:bigint,likeness:double>>"


def candidates(hits: DataFrame, sizes: DataFrame, k: int = K) -> DataFrame:
    """Spans (k, d, template, lo, hi) that the votes (k, d, template, tpos, diag) name."""
    diag = hits.groupBy("k", "d", "template", "diag").agg(
        F.count("*").alias("votes"), F.min("tpos").alias("t0"), F.max("tpos").alias("t1")).join(F.broadcast(sizes), "template")
    phrases = diag.filter("phrase AND votes = grams").select(
        "k", "d", "template", F.col("diag").alias("lo"), (F.col("diag") + F.col("grams") + (k - 1)).alias("hi"))
    # One document's diagonals of one template: at most as many as it has words.
    w = Window.partitionBy("k", "d", "template").orderBy("diag")
    gap = F.col("diag") - F.lag("diag").over(w)
    texts = (diag.filter("NOT phrase").withColumn("new", F.when(gap <= SLACK, 0).otherwise(1))
             .withColumn("run", F.sum("new").over(w))
             .groupBy("k", "d", "template", "run", "grams")
             .agg(F.sum("votes").alias("votes"), F.min(F.col("diag") + F.col("t0")).alias("lo"),
                  (F.max(F.col("diag") + F.col("t1")) + k).alias("hi"))
             .filter(F.col("votes") >= LEAST_VOTES * F.col("grams"))
             .select("k", "d", "template", "lo", "hi"))
    return phrases.union(texts)


def scan(df: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, id_col: str = "doc_id",
         text_col: str = "text", k: int = K) -> DataFrame:
    """One row per row of ``df``: doc_id, n_words, spans (verified, by first word)."""
    spark = df.sparkSession
    d = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # A row is named by its id and the hash of id and text.
    d = d.withColumn("k", F.xxhash64("doc_id", "text")).withColumn("d", F.coalesce("doc_id", F.lit(-1)))
    rows = _template_grams(templates, k)
    table = spark.createDataFrame(rows, "gram bigint, template int, tpos int")
    counts: dict[int, int] = {}
    for _, t, _ in rows:
        counts[t] = counts.get(t, 0) + 1
    sizes = spark.createDataFrame([(i, counts[i], t.phrase) for i, t in enumerate(templates)],
                                  "template int, grams int, phrase boolean")
    grams = map_arrow(d.select("k", "d", "text"), _grams(k), "k bigint, d bigint, grams array<bigint>")
    hits = (grams.select("k", "d", F.posexplode("grams").alias("pos", "gram")).join(F.broadcast(table), "gram")
            .select("k", "d", "template", "tpos", (F.col("pos") - F.col("tpos")).alias("diag")).distinct())
    texts = shared_table(map_arrow(d, _with_words([g for g, _, _ in rows], k),
                                   "k bigint, d bigint, doc_id bigint, n_words bigint, text string"), "scan")
    spans = candidates(hits, sizes, k).groupBy("k", "d").agg(F.collect_list(F.struct("template", "lo", "hi")).alias("spans"))
    named = texts.filter("text IS NOT NULL").select("k", "d", "text").dropDuplicates(["k", "d"]).join(spans, ["k", "d"])
    found = map_arrow(named.select("k", "d", "text", "spans"), _verify(templates), f"k bigint, d bigint, spans {SPANS}")
    out = texts.select("k", "d", "doc_id", "n_words").join(found, ["k", "d"], "left")
    return out.select("doc_id", "n_words", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["phrase"])
    firsts = F.transform(base, lambda s: s["first"])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda s: s["label"]))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["likeness"])), F.lit(0.0)).alias("score"))
