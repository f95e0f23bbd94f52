"""Extra columns that clash with names used inside, and memory for texts without blanks."""

import random

import public_tokenizers
import pyarrow as pa

from quern.llm import chunk_dedup, minmax, mixing, piece_encode, token_store

WORDS = "one two three four five six seven eight nine ten eleven twelve"


def test_clashing_columns_are_carried(spark):
    names = ["mix", "_visit", "visits", "_node", "node", "_sha2", "_SHA", "_keep", "row", "size", "bucket", "rank"]
    rows = [(i, f"{WORDS} {i // 2}", f"s{i % 2}", *[f"{n}{i}" for n in names]) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    whole = {tuple(r) for r in df.collect()}
    for out, ids in ((chunk_dedup.keep_last(df), {1, 3, 5, 7}), (minmax.keep_first(df), None), (mixing.curriculum(df), None)):
        got = out.collect()
        assert out.columns == df.columns and {tuple(r) for r in got} <= whole
        assert ids is None or {r["doc_id"] for r in got} == ids
    assert 0 in {r["doc_id"] for r in minmax.keep_first(df).collect()}


def test_texts_without_blanks_are_not_kept():
    """Texts of 20,000 characters of one word each: no word of theirs stays in a worker's tables, shorter ones do."""
    rng = random.Random(1)
    some = [chr(c) for c in range(0x4E00, 0x4F00)]
    model = piece_encode.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    sp, _, seen = piece_encode.encoder(model)
    store = token_store.word_encoder(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    for i in range(12):
        text = "".join(rng.choices(some, k=200)) * 100
        assert piece_encode.encode(text + " short", model).tolist() == sp.encode(text + " short")
        store.encode_many(pa.array([text + " short"]))
    kept = [*seen, *store.words.new, *store.words.old]
    assert any("short" in w for w in kept) and max(map(len, kept)) <= 64
