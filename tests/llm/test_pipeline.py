"""The pipeline: every stage's decisions against brute force on a small table."""

import hashlib

import corpus_pipeline as P
import public_tokenizers
import sentencepiece

from test_dedup import classes, copies

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark):
    rows = copies(8)
    english = [(i, t) for i, t in rows if t and "w" in t]
    extra = [(1000, None), (1001, "12 34"), (1002, english[0][1]), (1003, "")]
    return spark.createDataFrame([(d, t, "en", f"s{d % 4}" if d % 9 else None, len(t or "")) for d, t in rows + extra], COLUMNS)


def test_stages(spark, tmp_path):
    docs = documents(spark)
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix", "encode"]
    stage = dict(P.STAGES)
    kept = stage["language_id"](spark, docs, "")
    assert kept.columns == docs.columns
    lettered = {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in kept.collect()} == lettered
    once = stage["exact_dedup"](spark, kept, "")
    rows = once.collect()
    last: dict = {}
    for r in kept.collect():
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in rows} == set(last.values()) and len(rows) == len(last)
    near = stage["near_dedup"](spark, once, "")
    want = classes([(r.doc_id, r.text) for r in rows])
    assert sorted(r.doc_id for r in near.collect()) == sorted({c for _, c in want.values()})
    mixed = stage["mix"](spark, near, "")
    assert mixed.columns == docs.columns
    ids = {r.doc_id for r in near.collect()}
    assert {r.doc_id for r in mixed.collect()} <= ids
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = {r.doc_id: r.text for r in near.collect()}
    for x in stage["encode"](spark, mixed, "").collect():
        assert x.ids_sha256 == hashlib.sha256(",".join(map(str, sp.encode(text[x.doc_id]))).encode()).hexdigest()


def test_run_on_rows_and_on_nothing(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    assert P.run(spark, f"{tmp_path}/a").count() > 50
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert P.run(spark, f"{tmp_path}/b").count() == 0
