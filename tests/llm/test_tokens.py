"""Token counts, the token store and piece encoding against the libraries and brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from quern.llm import piece_encode as E
from quern.llm import token_dp as D
from quern.llm import token_store as S

MODEL = P.path("piece_bpe_32k.model")
WORDS = P.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string"
ODD = [None, "", " ", "  a  b \n c\t", "ﬁ ² K İ", "x" * 3000, "ab" * 4000, " " * 700, "漢字🙂" * 50, "▁ ▁▁a", "a\0b\x1cc\x85d\xa0e",
       "<|endoftext|> and <|startoftext|>x", "I'LL we've 'tis 2024 1,000", "é café", "ΣΑΣ ß ẞ"]


def strings(seed, n, alphabet):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randrange(0, 40))) for _ in range(n)]


def corpus():
    mixed = strings(4, 1500, [*" ab▁\n\té漢🙂THein'  s\"()\0\x1c\xa0́ﬁ,.019xİΣσ", "the ", "ing", " of", "<|endoftext|>"])
    return [*ODD, *mixed]


def test_pieces_equal_the_library():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = E.model_bytes(MODEL)
    for t in corpus():
        assert E.encode(t or "", model).tolist() == sp.encode(t or ""), repr(t)


def test_pieces_follow_the_merges():
    """Backtracking gives what the merges over the whole word give."""
    _, enc, _ = E.encoder(E.model_bytes(MODEL))
    for w in strings(9, 400, "thereinagofles"):
        assert enc.split(E.MARK + w) == enc.merge(E.MARK + w)


def test_texts_do_not_read_the_model_again(monkeypatch):
    """The model, half a MB, was hashed again for every text."""
    model = E.model_bytes(MODEL)
    first = E.encoder(model)
    monkeypatch.setattr(hashlib, "sha256", None)
    for t in corpus():
        E.encode(t or "", model)
    assert E.encoder(bytes(bytearray(model))) is first  # the next task's copy


def test_piece_table(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i if i else None, t, "x") for i, t in enumerate(corpus()[:200])] + [(7, "same", "y"), (7, "same", "y")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted((x.doc_id or 0, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in E.digest(E.encode_table(df, MODEL)).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t, _ in rows:
        ids = sp.encode(t or "")
        want.append((d or 0, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    assert got == sorted(want)
    assert E.encode_table(spark.createDataFrame([], SCHEMA), MODEL).count() == 0


def test_words_equal_the_tokenizers_library():
    from tokenizers import Tokenizer
    spec = open(WORDS, encoding="utf-8").read()
    enc, lib = S.word_encoder(spec), Tokenizer.from_str(spec)
    for t in corpus():
        assert np.frombuffer(enc.encode(t or ""), "<u2").tolist() == lib.encode(t or "", add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 3000])
@pytest.mark.parametrize("most", [2, 3, 60, 5000])
def test_elias_fano(n, most):
    rng = np.random.default_rng(n * most)
    lengths = rng.integers(1, most, n)
    ids = rng.integers(0, 49408, lengths.sum())
    data = S.pack(lengths, ids, 2)
    seg = S.Segment(data)
    ends = np.cumsum(lengths)
    assert (seg.ends() == ends).all()
    for i in [0, n - 1, *rng.integers(0, n, 30).tolist()]:
        assert seg.bounds(i) == (ends[i] - lengths[i], ends[i])
        assert (seg.ids_of(i) == ids[ends[i] - lengths[i]:ends[i]]).all()
    spare = len(data) - 2 * len(ids) - S.HEAD.size - 8
    assert spare * 8 <= n * (4 + math.log2(max(1, len(ids) / n)) + 32 / S.SAMPLE) + 64  # near the least space


def test_store(spark, tmp_path):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(WORDS)
    texts = corpus()[:300]
    order = list(range(len(texts)))
    random.Random(2).shuffle(order)
    rows = [(i * 3, texts[i], i) for i in order] + [(None, "no id", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, seg int").repartition(4)
    path = str(tmp_path / "store")
    S.write(df, path, WORDS, end_id=1, partitions=5, segment_ids=500)
    assert S.segments(spark, path).count() > 5
    got = {x.doc_id: (x.start, x.n_tokens, x.ids_crc32) for x in S.read_digest(spark, path).collect()}
    at, want = 0, {}
    for d, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want


def test_empty_store(spark, tmp_path):
    path = str(tmp_path / "none")
    S.write(spark.createDataFrame([], SCHEMA), path, WORDS)
    assert S.read_digest(spark, path).count() == 0


def best_count(word, scores, longest):
    best, used = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - longest), j):  # of equal scores the longest last piece
            s, k = scores.get(word[i:j]), 1
            if s is None and i == j - 1:
                k = len(word[i].encode())
                s = D.BYTE_SCORE * k
            if s is not None and best[i] + s > best[j]:
                best[j], used[j] = best[i] + s, used[i] + k
    return used[-1]


def test_trie_counts_equal_plain_dynamic_programming(spark):
    scores = D.zipf_scores(D.ranked_pieces(MODEL))
    pieces = D.Pieces(scores)
    words = sorted({w for t in corpus() for w in (t or "").split()} | {"thereinafter", "the", "there", "x" * 400})
    got = D.count_words([D.MARK + w for w in words], pieces)
    assert got.tolist() == [best_count(D.MARK + w, scores, pieces.longest) for w in words]
    rows = [(i if i else None, t) for i, t in enumerate(corpus()[:150])]
    table = D.token_counts(spark.createDataFrame(rows, SCHEMA), scores).collect()
    want = [(d or 0, len((t or "").split()), sum(best_count(D.MARK + w, scores, pieces.longest) for w in (t or "").split()))
            for d, t in rows]
    assert sorted((x.doc_id or 0, x.n_pretokens, x.n_tokens) for x in table) == sorted(want)
    assert D.token_counts(spark.createDataFrame([], SCHEMA), scores).count() == 0


def test_word_table_is_bounded_and_right():
    from quern.llm.common import WordTable
    made = []

    def make(w):
        made.append(w)
        return w.encode() + b";"
    table, r = WordTable(make, 10), random.Random(1)
    for _ in range(200):
        words = [r.choice(["a", "b", f"w{r.randrange(60)}"]) for _ in range(r.randrange(12))]
        assert table.join(words) == "".join(w + ";" for w in words).encode()
        assert len(table.new) <= 10 and len(table.old) <= 10
    assert made.count("a") < 5 and len(made) > 100
