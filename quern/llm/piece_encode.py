"""Merge-type (BPE) piece encoding by backtracking, and decoding.

A piece model that merges greedily gives one token sequence per text. The
sequence is found without running the merges over the whole text: at each
position the longest piece (Aho-Corasick) is tried first, then its shorter
prefixes; a piece may follow another only if merging the two pieces' own
text gives exactly those two pieces again. A position from which nothing
fits is marked and never entered again. A sequence whose
adjacent pieces are all compatible is the greedy result: merges inside two
neighbours run alike with and without the rest, so a merge across some
border would show in that pair alone.

Words repeat, so a worker keeps the token strings of words it has seen, up
to a fixed number of words. Texts are cut before runs of the space mark, a
cut that no piece of such a model crosses (checked when the model is read).

Nulls: a null text counts as empty, which has no tokens. Ids of rows are
carried as they are (null, repeated); extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, pieces_of

MARK = "▁"  # stands for a space
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")
#: Words and piece pairs a worker remembers before it starts afresh.
MOST_WORDS, MOST_PAIRS = 700_000, 400_000
#: Bits of a piece in a pair's key (ids and code points fit); no piece, and what the first piece follows.
WIDTH, NONE = 21, -1
START = (1 << WIDTH) - 1
#: Characters of a word that is kept, at most: memory is bounded in bytes.
LONG = 64


def model_bytes(path: str) -> bytes:
    """The vocabulary file, read on the driver: a fixed file of about half a MB."""
    with open(path, "rb") as f:
        return f.read()


class PieceEncoder:
    """Encodes words with the pieces, scores and byte fallback of a model."""

    def __init__(self, processor):
        import ahocorasick
        sp = processor
        normal = [i for i in range(sp.get_piece_size())
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        #: Pieces by id; a character outside the vocabulary is ``n`` and its code point.
        self.n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(self.n)]
        self.size = [len(p) for p in self.text]
        of = {self.text[i]: i for i in normal}
        self.score = {p: sp.get_score(i) for p, i in of.items()}
        if any(MARK in p.lstrip(MARK) for p in of):
            raise ValueError("a piece holds a space mark after other characters: words can't be cut")
        if not sp.is_byte(sp.piece_to_id("<0x00>")):
            raise ValueError("the model has no byte fallback")
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.machine = ahocorasick.Automaton()
        self.shorter = [NONE] * self.n
        for p, i in of.items():
            self.machine.add_word(p, i)
            self.shorter[i] = next((of[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in of), NONE)
        self.machine.make_automaton()
        self.pairs: dict[int, bool] = {}

    def merge(self, text: str) -> list[str]:
        """The greedy merges themselves: best score first, then leftmost."""
        out, score = list(text), self.score
        while len(out) > 1:
            best, at = None, -1
            for i in range(len(out) - 1):
                s = score.get(out[i] + out[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            out[at:at + 2] = [out[at] + out[at + 1]]
        return out

    def text_of(self, piece: int) -> str:
        return self.text[piece] if piece < self.n else chr(piece - self.n)

    def fits(self, left: int, right: int) -> bool:
        key = left << WIDTH | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            b = self.text_of(right)
            if left == START:
                known = self.merge(b) == [b]
            else:
                a = self.text_of(left)
                known = self.merge(a + b) == [a, b]
            self.pairs[key] = known
        return known

    def pieces(self, word: str) -> list[int]:
        """The pieces of a word; a character outside the vocabulary is a piece of its own."""
        n, vocabulary, size, shorter = len(word), self.n, self.size, self.shorter
        longest = [NONE] * n
        for end, piece in self.machine.iter(word):
            longest[end - size[piece] + 1] = piece  # ends rise: the longest comes last
        if NONE in longest:
            longest = [vocabulary + ord(c) if i == NONE else i for i, c in zip(longest, word)]
        if n and longest[0] < vocabulary and size[longest[0]] == n and self.fits(START, longest[0]):
            return [longest[0]]
        failed = bytearray(n + 1)
        known = self.pairs.get
        out: list[int] = []
        pos, left, piece = 0, START, longest[0] if n else NONE
        while pos < n:
            while piece != NONE:
                end = pos + (size[piece] if piece < vocabulary else 1)
                if not failed[end]:
                    ok = known(left << WIDTH | piece)
                    if self.fits(left, piece) if ok is None else ok:
                        break
                piece = shorter[piece] if piece < vocabulary else NONE
            if piece == NONE:
                if not out:
                    raise ValueError("no sequence of pieces fits")
                failed[pos] = 1
                piece = out.pop()  # its end has failed now: shorter ones follow
                pos -= size[piece] if piece < vocabulary else 1
                left = out[-1] if out else START
            else:
                out.append(piece)
                left, pos = piece, end
                if pos < n:
                    piece = longest[pos]
        return out

    def split(self, word: str) -> list[str]:
        """The text of each of a word's pieces."""
        return list(map(self.text_of, self.pieces(word)))

    def ids(self, word: str) -> list[int]:
        """Ids of a word of :func:`words_of`."""
        out = self.pieces(word if word.startswith(MARK) else MARK + word)
        if max(out) >= self.n:
            out = [i for p in out for i in ([p] if p < self.n else [self.byte[b] for b in chr(p - self.n).encode("utf-8", "replace")])]
        return out


def words_of(text: str) -> list[str]:
    """The words of a text, cut before each run of marks.

    Where single spaces are all there is, a word is the text between them
    and its one mark is understood; otherwise words carry their marks.
    """
    words = text.split(" ")
    if "" in words or MARK in text:
        return _RUNS.findall(MARK + text.replace(" ", MARK))
    return words


_ENCODERS: dict[bytes, tuple] = {}


def encoder(model: bytes) -> tuple:
    """The worker's processor, encoder and word table for a model.

    The bytes themselves are the key: Python hashes them once an object,
    so asking again for every text costs nothing.
    """
    if model not in _ENCODERS:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        _ENCODERS[model] = (sp, PieceEncoder(sp), {})
    return _ENCODERS[model]


def encode(text: str, model: bytes) -> np.ndarray:
    """The ids of one text (int32)."""
    if not text:
        return np.empty(0, np.int32)
    _, enc, seen = encoder(model)
    words = words_of(text)
    if len(seen) > MOST_WORDS:
        seen.clear()
    long: dict[str, bytes] = {}  # whole texts without a blank, in some scripts: not kept
    for w in set(words).difference(seen):
        (seen if len(w) <= LONG else long)[w] = array("i", enc.ids(w)).tobytes()
    find = seen.__getitem__ if not long else lambda w: long[w] if w in long else seen[w]
    return np.frombuffer(b"".join(map(find, words)), np.int32)


def _step(model_b):
    def make():
        model = model_b.value
        sp = encoder(model)[0]

        def step(b: pa.RecordBatch):
            texts = b.column("text").to_pylist()
            for lo, hi in pieces_of(np.array([len(t or "") + 1 for t in texts]), 2_000_000):
                ids = [encode(t or "", model) for t in texts[lo:hi]]
                back = sp.decode([x.tolist() for x in ids], num_threads=1)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(back, pa.string())],
                    names=["doc_id", "ids", "decoded"])
        return step
    return make


def encode_table(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string: one row per row of ``df``, no shuffle."""
    model_b = df.sparkSession.sparkContext.broadcast(model_bytes(model_path))
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, _step(model_b), f"doc_id {kind}, ids array<int>, decoded string")


def digest(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of :func:`encode_table`, and ``more`` of its columns."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more)
