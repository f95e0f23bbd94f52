"""The prefix trie of rebuilt conversations against brute force, and its checks."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from quern.llm import conversation_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, depth string"


def brute(rows):
    stored = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            stored[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in stored.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = turns.get(c - c % 20 if c >= 0 else c + -c % 20, [])
        rebuilt[c] = tuple(base[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = own + sum(saved[k] for k in kids[p])
    out = set()
    for p, who in members.items():
        ends = [c for c in who if len(rebuilt[c]) == len(p)]
        out.add((who[0], len(p), members[p[:-1]][0] if p else None, len(who), len(kids[p]), leaves[p], saved[p],
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out, rebuilt


def built(spark, rows, **options):
    got = T.trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    return {tuple(r)[:8] for r in got}, got


def talk(rng, n, vocabulary=6):
    return [(rng.choice(["user", "assistant", None, ""]), rng.choice(["a b", "a  b", "", None, "x", "long " * 30][:vocabulary])) for _ in range(n)]


def conversations(rng):
    rows, common = [], talk(rng, 5)
    for c in list(range(0, 130)) + [400, 405, 419, -3, -20]:
        kind = rng.random()
        turns = common if kind < 0.3 else (common[:rng.randint(1, 5)] + talk(rng, rng.randint(0, 4), 3) if kind < 0.7 else talk(rng, rng.randint(1, 7)))
        rows += [(c, i if i or rng.random() < 0.8 else None, r, t, 1, "clash") for i, (r, t) in enumerate(turns)]
    alone = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4)
    rows = [r for r in rows if r[0] not in (0, 40, alone)] + [(0, 0, "user", "only", 1, "")]   # a short base, an absent one
    rows += [(alone, 0, "user", "one turn", 1, "")]
    rows += [(None, 1, "user", "no conversation", 1, "")] + rng.sample(rows[:-1], 20)     # repeated rows
    rows += [(500, i, "user", f"turn {i % 50}", 1, "") for i in range(700)]               # one long conversation, and its like
    rows += [(500 + 20, i, "user", f"turn {i % 50}", 1, "") for i in range(650)]
    return rows


def test_equals_brute_force(spark):
    rows = conversations(random.Random(11))
    want, rebuilt = brute(rows)
    assert () in rebuilt.values()                                                          # a conversation without turns
    got, nodes = built(spark, rows)
    assert got == want
    stored = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            stored[c].append((turn is not None, turn or 0, role or "", text or ""))
    for n in nodes:                                                                        # the stored turn is the node's last
        if n.depth:
            assert sorted(stored[n.turn_conv_id])[n.turn_pos][2:] == rebuilt[n.conv_id][n.depth - 1]


def test_unequal_sequences_of_one_fingerprint_are_found(spark):
    rows = [(c, i, "user", t, 1, "") for c in range(21, 33) for i, t in enumerate(["xyzabc", "xyzacb", "xyzabd"][c % 3])]

    class Orderless(T.Bases):
        def __init__(self, seed):
            super().__init__(seed)
            self.b = [1] * len(T.PRIMES)                                                   # sums: order is lost

    class Deaf(T.Bases):
        def value(self, j):
            return T.F.pmod(T.F.length("text") + T.F.length("role"), T.F.lit(7)).cast("bigint") + 1   # all texts alike

    want, _ = brute(rows)
    assert built(spark, rows, attempts=(Orderless(1), Deaf(2), T.Bases(3)))[0] == want
    for unfit in (Orderless(1), Deaf(2)):
        with pytest.raises(ValueError):
            built(spark, rows, attempts=(unfit,))


def test_many_ends_are_one_digest(spark):
    rows = [(c, 0, "user", "same words here", 1, "") for c in range(0, 6000)]
    got, _ = built(spark, rows, base=lambda c: c, head=lambda c: T.F.lit(0).cast("bigint"))
    ids = ",".join(map(str, range(6000)))
    assert got == {(0, 0, None, 6000, 1, 1, 5999 * 3, hashlib.sha256(b"").hexdigest()),
                   (0, 1, 0, 6000, 0, 1, 5999 * 3, hashlib.sha256(ids.encode()).hexdigest())}


def test_empty_table(spark):
    assert built(spark, [])[0] == set()
    assert built(spark, [(None, 1, "user", "x", 1, "")])[0] == set()
