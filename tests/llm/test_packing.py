"""Histogram-planned packing against piece-by-piece best-fit and the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quern.llm import length_packing as P
from quern.llm import queries as Q

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def best_fit(lengths, capacity):
    """Rooms left by best-fit decreasing, one piece after the other."""
    left: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in left if r >= n]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - n)
        else:
            left.append(capacity - n)
    return sorted(left)


def placed(slots):
    """(sequence, offset, length) of every planned piece."""
    for s in slots:
        for i in range(s.n * s.per):
            yield s.sequence + i // s.per, s.offset + i % s.per * s.length, s.length


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for trial in range(300):
        capacity = rng.choice([1, 2, 7, 16, 64, 100])
        lengths = [rng.randint(1, capacity if trial % 3 else max(1, capacity // 3)) for _ in range(rng.randint(0, 300))]
        if trial % 5 == 0:
            lengths += [rng.randint(1, capacity)] * 200
        slots, opened = P.plan(Counter(lengths), capacity)
        want = best_fit(lengths, capacity)
        assert opened == len(want)
        where = defaultdict(list)
        for sequence, offset, length in placed(slots):
            where[sequence].append((offset, length))
        used = []
        for parts in where.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
            used.append(capacity - sum(n for _, n in parts))
        assert sorted(used) == want
        ranks = defaultdict(set)
        for s in slots:
            ranks[s.length] |= set(range(s.rank, s.rank + s.n * s.per))
        assert {n: len(r) for n, r in ranks.items()} == dict(Counter(lengths))


def test_plan_size_is_bounded_by_the_capacity():
    rng = random.Random(4)
    counts = {n: rng.randint(1, 10 ** 9 if n < 400 else 10 ** 6) for n in range(1, 1025)}
    slots, opened = P.plan(counts)
    total = sum(n * c for n, c in counts.items())
    assert len(slots) < 20 * 1024 and total <= opened * 1024 < 1.001 * total


def test_encoder_equals_the_library():
    enc, lib = P.byte_encoder(open(VOCABULARY, encoding="utf-8").read()), Tokenizer.from_file(VOCABULARY)
    rng = random.Random(8)
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|> b", "<|endoftext", "I'll they'VE 123,45  \n\n x\t", "中文" * 700, " " * 50_000 + "x",
             "ab" * 60_000, "x " * 60_000, "  \u0085 a", "é\U0001f600‍"]
    alphabet = "ab 1!'\n\téİकि中  \U0001f600s"
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)]
    for t in texts:
        assert enc.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids


def check(rows, texts):
    """The result ``rows`` of documents ``texts`` (id, text): contract, library ids, gapless sequences."""
    lib = Tokenizer.from_file(VOCABULARY)
    want, lengths = Counter(), []
    for doc, text in texts:
        ids = np.array(lib.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = list(range(len(ids), 0, -1024))[::-1]
        for piece, (a, b) in enumerate(zip([0] + cuts, cuts)):
            want[doc, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
            lengths.append(b - a)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    where = defaultdict(list)
    for r in rows:
        where[r.sequence_id].append((r.offset, r.length))
    for parts in where.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 1024
    assert len(where) == len(best_fit(lengths, 1024))


def test_query_over_the_table(spark):
    from conftest import SF
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(Q.op12_length_packing(spark, SF).collect(), [(r.doc_id, r.text) for r in docs])


def test_odd_rows(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "no id", "x", 1), (None, None, "x", 1), (3, "twice", "x", 1), (3, "twice", "x", 1),
            (4, "word " * 1023, "x", 1), (5, "word " * 1024, "x", 1), (6, "ab c" * 40_000, "x", 1), (7, "word " * 2047, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, part int").repartition(3)
    packed = P.pack(P.pieces(df, VOCABULARY)).cache()
    check(packed.collect(), [(r[0], r[1]) for r in rows])
    whole = P.sequences(packed).collect()
    for s in whole:
        assert s.n_tokens * 4 == len(s.ids) and sum(d.length for d in s.documents) == s.n_tokens
    crc = {(r.sequence_id, r.offset): r.ids_crc32 for r in packed.collect()}
    assert all(zlib.crc32(bytes(s.ids[4 * d.offset:4 * (d.offset + d.length)])) == crc[s.sequence_id, d.offset]
               for s in whole for d in s.documents)
    empty = df.filter("doc_id = 99")
    assert P.pack(P.pieces(empty, VOCABULARY)).collect() == []
