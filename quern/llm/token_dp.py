"""Token counts by trie-shared dynamic programming.

A text's pre-tokens (runs without white space, each with a leading space
mark) repeat and share beginnings. A task sorts the distinct pre-tokens of
its rows into a trie and computes the best unigram segmentation once per
trie node: the score of a node is the best, over the pieces that end there,
of the score of the node where the piece begins plus the piece's own score.
The tokens of the best segmentation are kept at each terminal, and a text's
count is the sum over its pre-tokens.

The trie is processed by depth, all nodes of a depth at once. A character
outside the vocabulary counts as its UTF-8 bytes at a fixed penalty each.
Of equal scores the segmentation with the longest last piece wins.

Nulls: a null text has no pre-token (0 tokens). Ids are carried as they
are; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, mix64, pieces_of

MARK = "▁"
#: Log-probability of each byte of a character that no piece covers.
BYTE_SCORE = -20.0
#: Characters of text a task takes at a time into one trie.
TRIE_CHARS = 6_000_000


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Unigram log-probabilities of a ranked vocabulary: p ~ 1 / (rank + 2.7) (Zipf-Mandelbrot)."""
    p = 1.0 / (np.arange(len(pieces)) + 2.7)
    return dict(zip(pieces, np.log(p / p.sum()).tolist()))


def ranked_pieces(model_path: str) -> list[str]:
    """The normal pieces of a piece model, best first."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(sp.get_piece_size())
           if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return [sp.id_to_piece(i) for i in sorted(ids, key=lambda i: (-sp.get_score(i), i))]


class Pieces:
    """A vocabulary as an open hash table from the hash of a piece to its score."""

    BASE = np.uint64(0x100000001B3)

    def __init__(self, scores: dict[str, float]):
        self.longest = max(map(len, scores))
        size = 1 << (len(scores) * 8 - 1).bit_length()
        self.mask = np.uint64(size - 1)
        self.key = np.zeros(size, np.uint64)
        self.score = np.full(size, -np.inf)
        for piece, score in scores.items():
            h = self.hash_of(piece)
            at = int(self.slot(np.array([h], np.uint64))[0])
            while self.key[at]:
                if self.key[at] == h:
                    raise ValueError("two pieces with one hash")
                at = (at + 1) & int(self.mask)
            self.key[at], self.score[at] = h, score

    def hash_of(self, piece: str) -> int:
        """Sum of code point times base to the distance from the piece's end, grown to the left."""
        h, m = 0, 1
        for c in reversed(piece):
            h = (h + ord(c) * m) & 0xFFFFFFFFFFFFFFFF
            m = m * int(self.BASE) & 0xFFFFFFFFFFFFFFFF
        return (h * 31 + len(piece)) & 0xFFFFFFFFFFFFFFFF

    def slot(self, h: np.ndarray) -> np.ndarray:
        return mix64(h) & self.mask

    def lookup(self, h: np.ndarray) -> np.ndarray:
        at = self.slot(h)
        out = np.full(h.shape, -np.inf)
        todo = np.arange(h.size)
        flat, at = h.reshape(-1), at.reshape(-1)
        res = out.reshape(-1)
        while len(todo):
            k = self.key[at]
            hit = k == flat[todo]
            res[todo[hit]] = self.score[at[hit]]
            go = ~hit & (k != 0)
            todo, at = todo[go], (at[go] + np.uint64(1)) & self.mask
        return out


def count_words(words: list[str], pieces: Pieces) -> np.ndarray:
    """Tokens in the best segmentation of each of the distinct, sorted ``words``."""
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    begin = np.cumsum(sizes) - sizes
    out = np.zeros(n, np.int64)
    k = pieces.longest
    power = np.cumprod(np.concatenate(([1], np.full(k - 1, pieces.BASE))).astype(np.uint64), dtype=np.uint64)
    # Of the live words: their node; of each node: the best scores, counts and
    # suffix hashes of its last k ancestors (nearest first).
    live = np.flatnonzero(sizes > 0)
    node = np.zeros(len(live), np.int64)
    best = np.full((1, k), -np.inf)
    best[0, 0] = 0.0
    used = np.zeros((1, k), np.int64)
    suffix = np.zeros((1, k), np.uint64)  # column j: hash of the last j characters
    depth = 0
    while len(live):
        c = codes[begin[live] + depth]
        fresh = np.ones(len(live), bool)  # sorted words: one node's words stand together
        fresh[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])
        parent, char = node[fresh], c[fresh]
        node = np.cumsum(fresh) - 1
        # suffix of j + 1 characters = suffix of j characters moved left by one, plus the new character
        grown = suffix[parent] * pieces.BASE + char[:, None]
        span = min(depth + 1, k)
        sizes_of = np.arange(1, span + 1, dtype=np.uint64)
        score = pieces.lookup(grown[:, :span] * np.uint64(31) + sizes_of)
        width = np.where(char < 0x80, 1, np.where(char < 0x800, 2, np.where(char < 0x10000, 3, 4)))
        alone = np.isneginf(score[:, 0])
        score[alone, 0] = BYTE_SCORE * width[alone]
        cost = np.ones(score.shape, np.int64)
        cost[alone, 0] = width[alone]
        total = best[parent, :span] + score
        pick = span - 1 - np.argmax(total[:, ::-1], axis=1)  # the longest of equal pieces
        rows = np.arange(len(parent))
        now, count = total[rows, pick], used[parent, pick] + cost[rows, pick]
        best = np.concatenate([now[:, None], best[parent, :-1]], axis=1)
        used = np.concatenate([count[:, None], used[parent, :-1]], axis=1)
        suffix = np.concatenate([np.zeros((len(parent), 1), np.uint64), grown[:, :-1]], axis=1)
        depth += 1
        done = sizes[live] == depth
        out[live[done]] = count[node[done]]
        live, node = live[~done], node[~done]
        if not len(live):
            break
        keep, node = np.unique(node, return_inverse=True)
        best, used, suffix = best[keep], used[keep], suffix[keep]
    return out


def _step(pieces_b):
    def make():
        pieces = Pieces(pieces_b.value)

        def step(b: pa.RecordBatch):
            texts = b.column("text").to_pylist()
            for lo, hi in pieces_of(np.array([len(t or "") + 1 for t in texts]), TRIE_CHARS):
                place: dict[str, int] = {}
                runs = [[place.setdefault(w, len(place)) for w in (t or "").split()] for t in texts[lo:hi]]
                words = sorted(place)
                tokens = np.zeros(max(len(words), 1), np.int64)
                if words:
                    tokens[[place[w] for w in words]] = count_words([MARK + w for w in words], pieces)
                n = np.array([len(r) for r in runs], np.int64)
                m = np.array([int(tokens[r].sum()) if r else 0 for r in runs], np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[lo:hi], pa.array(n), pa.array(m)],
                                                 names=["doc_id", "n_pretokens", "n_tokens"])
        return step
    return make


def token_counts(df: DataFrame, scores: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens: one row per row of ``df``, no shuffle.

    ``scores`` maps pieces to log-probabilities; it is broadcast (a vocabulary
    of fixed size, tens of thousands of pieces).
    """
    pieces_b = df.sparkSession.sparkContext.broadcast(scores)
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, _step(pieces_b), f"doc_id {kind}, n_pretokens bigint, n_tokens bigint")
