"""Language of words and texts by a linear-chain conditional random field.

Every word of a text is a position of the chain. Its features are hashed:
prefixes and suffixes of one to three letters, letter bigrams and trigrams
(with word borders), and membership in a lexicon of frequent words learned
with the model. Transitions between the languages of neighbouring words are
learned too, from chains that splice runs of words of different languages
(code-switched text); forward-backward gives each word its probabilities.
The language of a text is the one with the largest mean probability over
its words, and that mean is its score.

Words are runs of letters, lower-cased. A text that is null or has no
letter is ``und`` with score 0. With no labelled text to learn from, every
text is ``und``. Ties go to the first language in order. Rows may repeat;
ids may be null (such rows are predicted, and never learned from); extra
columns are ignored. Very long texts are one chain like any other, read
whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, pieces_of

UNKNOWN = "und"
#: The labelled sample the model is fitted on: so many texts of each language,
#: of at most so many characters each; of longer texts so many pieces.
DOCS_PER_LANG, SAMPLE_CHARS, PIECES = 80, 40_000, 8
#: Frequent words of each language in the lexicon.
LEXICON_WORDS = 4000
GRAM_BITS, LEXICON_BITS = 17, 16
#: Words in a training chain, and the mean run of one language in it.
CHAIN, RUN = 64, 12
EPOCHS, RATE, L2 = 24, 0.4, 1e-6

_U = np.uint32
_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


@dataclass
class Features:
    """Feature slots of the words of some texts."""

    gram: np.ndarray       # slots of the letters' bigrams and trigrams, shape (letters, 2)
    begin: np.ndarray      # first letter of each word
    affix: np.ndarray      # (words, 6); slot 0 where the word is too short
    name: np.ndarray       # 64-bit hash of each word
    count: np.ndarray      # words of each text


def _slot(x: np.ndarray, salt: int) -> np.ndarray:
    h = (x + _U(salt)) * _U(0xC2B2AE3D)
    h ^= h >> _U(15)
    return ((h * _U(0x27D4EB2F)) >> _U(32 - GRAM_BITS)).astype(np.int32) | 1  # never slot 0


def features(texts: list[str]) -> Features:
    text = "\n".join(t.lower() for t in texts)
    ends = np.cumsum([len(t.lower()) + 1 for t in texts])
    codes = np.frombuffer((text + "\n").encode("utf-32-le", "replace"), np.uint32)
    inside = letters()[codes]
    edge = np.diff(np.concatenate(([False], inside)).astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    count = np.diff(np.concatenate(([0], np.searchsorted(start, ends))))
    c = codes[inside]
    size = stop - start
    begin = np.cumsum(size) - size
    last = begin + size - 1
    before, after = np.empty_like(c), np.empty_like(c)
    before[1:], after[:-1] = c[:-1], c[1:]
    before[begin], after[last] = 0, 0
    two = c * _U(0x9E3779B1) + after * _U(0x85EBCA77)
    gram = np.stack([_slot(two, 1), _slot(two + before * _U(0x165667B1), 2)], axis=1)
    affix = np.zeros((len(size), 6), np.int32)
    for k in range(3):
        long = size > k
        p = s = np.zeros(int(long.sum()), np.uint32)
        for i in range(k + 1):
            p = p * _U(0x01000193) + c[begin[long] + i]
            s = s * _U(0x01000193) + c[last[long] - i]
        affix[long, k], affix[long, 3 + k] = _slot(p, 11 + k), _slot(s, 21 + k)
    place = np.arange(len(c)) - np.repeat(begin, size)
    power = np.cumprod(np.concatenate(([1], np.full(int(size.max(initial=1)) - 1, 0x9E3779B97F4A7C15))).astype(np.uint64), dtype=np.uint64)
    name = np.add.reduceat(c * power[place], begin) if len(begin) else np.empty(0, np.uint64)
    return Features(gram, begin, affix, name ^ (name >> np.uint64(29)), count)


@dataclass
class Model:
    labels: list[str]
    weight: np.ndarray     # (2**GRAM_BITS, labels)
    known: np.ndarray      # word hash that holds a lexicon slot, 0 where free
    lexicon: np.ndarray    # (2**LEXICON_BITS, labels)
    step: np.ndarray       # transition scores (from, to)
    first: np.ndarray      # scores of the first word

    def lexicon_slots(self, name: np.ndarray) -> np.ndarray:
        at = (name & np.uint64(len(self.known) - 1)).astype(np.int64)
        return np.where(self.known[at] == name, at, -1)

    def emissions(self, f: Features) -> np.ndarray:
        if not len(f.begin):
            return np.zeros((0, len(self.labels)), np.float32)
        e = np.add.reduceat(self.weight[f.gram[:, 0]] + self.weight[f.gram[:, 1]], f.begin, axis=0)
        for k in range(6):
            e += self.weight[f.affix[:, k]]
        at = self.lexicon_slots(f.name)
        hit = at >= 0
        e[hit] += self.lexicon[at[hit]]
        return e


def _scan(psi: np.ndarray, reset: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Normalised forward vectors of many chains laid end to end.

    ``reset`` marks the first word of each chain. The line is cut into equal
    blocks that run side by side from every label at once; what enters a
    block is then known from the block before, so the result is that of the
    plain recursion.
    """
    n, k = psi.shape
    width = max(1, int(np.sqrt(n / 2)))
    blocks = -(-n // width)
    pad = blocks * width - n
    x = np.concatenate([psi, np.ones((pad, k), psi.dtype)]).reshape(blocks, width, k)
    r = np.concatenate([reset, np.ones(pad, bool)]).reshape(blocks, width)
    v = np.broadcast_to(np.eye(k, dtype=psi.dtype), (blocks, k, k))
    out = np.empty((blocks, width, k, k), psi.dtype)
    for s in range(width):
        w = (v.reshape(-1, k) @ step).reshape(blocks, k, k)
        at = r[:, s]
        if at.any():
            w[at] = v[at].sum(axis=2, keepdims=True) * first
        w *= x[:, s, None, :]
        w /= w.reshape(blocks, -1).max(axis=1)[:, None, None]
        out[:, s] = v = w
    carry = np.empty((blocks, k), psi.dtype)
    now = np.full(k, 1.0 / k, psi.dtype)
    for b in range(blocks):
        carry[b] = now
        now = now @ out[b, -1]
        now /= now.sum()
    a = np.matmul(carry[:, None, None, :], out).reshape(-1, k)[:n]
    return a / a.sum(axis=1, keepdims=True)


def marginals(e: np.ndarray, count: np.ndarray, model: Model) -> np.ndarray:
    """Probabilities of each word's labels, by forward-backward over each text."""
    if not len(e):
        return e.astype(np.float64)
    psi = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -30)).astype(np.float64)
    step, first = np.exp(model.step), np.exp(model.first)
    begins = (np.cumsum(count) - count)[count > 0]
    reset = np.zeros(len(e), bool)
    reset[begins] = True
    ahead = _scan(psi, reset, step, first)
    end = np.zeros(len(e), bool)
    end[np.concatenate((begins[1:] - 1, [len(e) - 1]))] = True
    back = _scan(psi[::-1], end[::-1], step.T, np.ones_like(first))[::-1]
    p = ahead * back / psi
    return p / p.sum(axis=1, keepdims=True)


# --- learning -----------------------------------------------------------

def train(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """Fit a model on (language, text) rows by full-batch AdaGrad on the chain likelihood."""
    rows = sorted(r for r in rows if r[0] is not None and r[1])
    f = features([t for _, t in rows])
    labels = sorted({lang for (lang, _), n in zip(rows, f.count) if n})
    if not labels:
        return None
    k, n = len(labels), len(f.begin)
    y = np.repeat([labels.index(lang) if c else 0 for (lang, _), c in zip(rows, f.count)], f.count)
    model = Model(labels, np.zeros((1 << GRAM_BITS, k), np.float32), np.zeros(1 << LEXICON_BITS, np.uint64),
                  np.zeros((1 << LEXICON_BITS, k), np.float32), np.zeros((k, k)), np.zeros(k))
    for l in range(k):
        names, c = np.unique(f.name[y == l], return_counts=True)
        for h in names[np.lexsort((names, -c))][:LEXICON_WORDS][np.sort(-c)[:LEXICON_WORDS] < -1]:
            at = int(h) & (len(model.known) - 1)
            if not model.known[at]:
                model.known[at] = h
    # Chains: runs of words of one text, dealt at random, so that languages switch.
    rng = np.random.default_rng(seed)
    cuts = np.unique(np.concatenate((np.cumsum(f.count) - f.count, np.flatnonzero(rng.random(n) < 1 / RUN), [0])))
    cuts = cuts[cuts < n]
    sizes = np.diff(np.concatenate((cuts, [n])))
    deal = rng.permutation(len(cuts))
    order = np.concatenate([np.arange(cuts[i], cuts[i] + sizes[i]) for i in deal])
    chains = max(1, n // CHAIN)
    length = min(CHAIN, n)
    seq = order[:chains * length].reshape(chains, length)
    tied = y[seq]
    word_of = np.repeat(np.arange(n), np.diff(np.concatenate((f.begin, [len(f.gram)]))))
    lex = model.lexicon_slots(f.name)
    hit = lex >= 0
    seen = [np.full_like(p, 1e-3, dtype=np.float64) for p in (model.weight, model.lexicon, model.step, model.first)]
    for _ in range(EPOCHS):
        e = model.emissions(f)
        psi = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -30)).astype(np.float64)[seq]
        step, first = np.exp(model.step), np.exp(model.first)
        a, b = np.empty_like(psi), np.ones_like(psi)
        for t in range(length):
            a[:, t] = (a[:, t - 1] @ step if t else first) * psi[:, t]
            a[:, t] /= a[:, t].sum(axis=1, keepdims=True)
        for t in range(length - 2, -1, -1):
            b[:, t] = (psi[:, t + 1] * b[:, t + 1]) @ step.T
            b[:, t] /= b[:, t].sum(axis=1, keepdims=True)
        p = a * b
        p /= p.sum(axis=2, keepdims=True)
        g = np.zeros((n, k))
        g[seq] = np.eye(k)[tied] - p
        g_step, g_first = np.zeros((k, k)), (np.eye(k)[tied[:, 0]] - p[:, 0]).sum(axis=0)
        for t in range(1, length):
            pair = a[:, t - 1, :, None] * step * (psi[:, t] * b[:, t])[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            g_step -= pair.sum(axis=0)
            np.add.at(g_step, (tied[:, t - 1], tied[:, t]), 1.0)
        by_letter = g[word_of]
        g_weight, g_lex = np.empty(model.weight.shape), np.empty(model.lexicon.shape)
        for l in range(k):
            w = np.bincount(f.gram.T.reshape(-1), np.tile(by_letter[:, l], 2), 1 << GRAM_BITS)
            w += np.bincount(f.affix.T.reshape(-1), np.tile(g[:, l], 6), 1 << GRAM_BITS)
            g_weight[:, l] = w
            g_lex[:, l] = np.bincount(lex[hit], g[hit, l], 1 << LEXICON_BITS)
        g_weight[0] = 0  # the slot of missing affixes
        for q, d, h in zip((model.weight, model.lexicon, model.step, model.first), (g_weight, g_lex, g_step, g_first), seen):
            d = d / n * 1000 - L2 * q
            h += d * d
            q += (RATE * d / np.sqrt(h)).astype(q.dtype)
    return model


def _pieces(text):
    """The words of a long text, or runs of them spread evenly over it, ``SAMPLE_CHARS`` characters in all."""
    words = F.regexp_replace(text, r"[^\p{L}]+", " ")  # blanks for what no word holds
    size = SAMPLE_CHARS // PIECES
    step = (F.length(words) - size) / (PIECES - 1)
    cut = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)),
                      lambda i: F.substr(words, (F.floor(i * step) + 1).cast("int"), F.lit(size)))
    # A word cut at the border of a piece goes.
    whole = F.transform(cut, lambda p: F.regexp_replace(p, r"^\p{L}{0,99} | \p{L}{0,99}$", " "))
    return F.when(F.length(words) <= SAMPLE_CHARS, words).otherwise(F.concat_ws(" ", whole))


def sample(df: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> list[tuple[str, str]]:
    """Up to ``docs_per_lang`` labelled texts of each language, by the order of a hash.

    ``df`` has the columns doc_id, text, lang; rows without any of them are
    left out. Texts of up to ``SAMPLE_CHARS`` come first, and whole; where a
    language has too few of them, runs of words of its longer ones follow.
    """
    d = df.filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    d = d.withColumn("_h", F.xxhash64("doc_id", "text")).withColumn("_long", F.length("text") > SAMPLE_CHARS)
    n = {(r["lang"], r["_long"]): r["count"] for r in d.groupBy("lang", "_long").count().collect()}  # two rows a language
    if not n:
        return []
    share = F.lit(1.0)
    for (lang, long), c in n.items():
        some = not long or n.get((lang, False), 0) < docs_per_lang
        share = F.when((F.col("lang") == lang) & (F.col("_long") == long),
                       F.lit(min(1.0, 8.0 * docs_per_lang / c) if some else 0.0)).otherwise(share)
    w = Window.partitionBy("lang").orderBy("_long", "_h", "doc_id")
    thin = d.filter(F.pmod("_h", F.lit(1_000_003)) < share * 1_000_003)
    thin = thin.withColumn("text", F.when(F.col("_long"), _pieces(F.col("text"))).otherwise(F.col("text")))
    keep = thin.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= docs_per_lang)
    return [(r["lang"], r["text"]) for r in keep.select("lang", "text").collect()]


# --- predicting ---------------------------------------------------------

RUNS = "array<struct<lang:string,first:bigint,words:bigint>>"


def _runs(best: np.ndarray, count: np.ndarray, labels: list[str]) -> list:
    out, at = [], 0
    for c in count.tolist():
        b = best[at:at + c]
        cut = np.concatenate(([0], np.flatnonzero(np.diff(b)) + 1)) if c else np.empty(0, np.int64)
        size = np.diff(np.concatenate((cut, [c]))) if c else cut
        out.append([{"lang": labels[b[i]], "first": int(i), "words": int(s)} for i, s in zip(cut, size)])
        at += c
    return out


def _step(model_b, runs: bool):
    def make():
        model: Model | None = model_b.value

        def step(b: pa.RecordBatch):
            texts = [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in pieces_of(np.array([len(t) + 1 for t in texts]), 800_000):
                f = features(texts[lo:hi])
                lang, score = [UNKNOWN] * (hi - lo), np.zeros(hi - lo)
                spans: list = [[] for _ in range(hi - lo)]
                some = np.flatnonzero(f.count)
                if model is not None and len(some):
                    p = marginals(model.emissions(f), f.count, model)
                    begins = (np.cumsum(f.count) - f.count)[some]
                    mean = np.add.reduceat(p, begins, axis=0) / f.count[some][:, None]
                    for i, l in zip(some.tolist(), np.argmax(mean, axis=1).tolist()):
                        lang[i] = model.labels[l]
                    score[some] = np.clip(mean.max(axis=1), 0, 1)
                    if runs:
                        spans = _runs(np.argmax(p, axis=1), f.count, model.labels)
                cols = [b.column("doc_id")[lo:hi], pa.array(lang), pa.array(score), pa.array(f.count.astype(np.int64))]
                names = ["doc_id", "lang_pred", "score", "n_words"]
                if runs:
                    kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("words", pa.int64())]))
                    cols, names = [*cols, pa.array(spans, kind)], [*names, "runs"]
                yield pa.RecordBatch.from_arrays(cols, names=names)
        return step
    return make


def predict(df: DataFrame, model: Model | None, runs: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, n_words (and ``runs``: the code-switched runs of words) of every row."""
    model_b = df.sparkSession.sparkContext.broadcast(model)  # fixed size: hashed tables
    d = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return map_arrow(d, _step(model_b, runs), f"doc_id {kind}, lang_pred string, score double, n_words bigint"
                     + (f", runs {RUNS}" if runs else ""))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(df: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> Model | None:
    """A model from the rows of ``df`` that aren't held out."""
    return train(sample(df.filter(~held_out()).select("doc_id", "text", "lang"), docs_per_lang))
