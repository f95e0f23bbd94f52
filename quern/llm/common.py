"""Helpers shared by the training-data operators.

Nothing here decides anything; it moves text into numpy and tables into
the shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import checkpoint_dir, ship_package

#: ``[^\x20\x09-\x0D]+`` as a byte mask: all separators are ASCII, so bytes do.
BLANK_WORD = np.ones(256, bool)
BLANK_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and every non-ASCII byte.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table every executor can read again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same_text(df: DataFrame, text_col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(df[text_col], F.lit(""))


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with a per-task setup: ``make()`` returns the batch function.

    Ships the package to the workers, so pickled functions can be imported there.
    """
    ship_package(df.sparkSession)

    def run(batches):
        step = make()
        for b in batches:
            if b.num_rows:
                yield from step(b)
    return df.mapInArrow(run, schema)


def pieces_of(sizes: np.ndarray, budget: int) -> Iterator[tuple[int, int]]:
    """Cut rows into consecutive runs of about ``budget`` units (one row at least)."""
    at = 0
    ends = np.cumsum(sizes)
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + budget, "right")))
        yield at, to
        at = to


class Words:
    """The words of many texts, as numpy arrays over one byte buffer.

    ``doc`` holds each word's text (rising), ``hash`` its 64-bit
    polynomial hash, ``first`` the index of each text's first word (and
    one past the last).
    """

    def __init__(self, texts: list[bytes], mask: np.ndarray):
        buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        inside = mask[buf]
        edge = np.diff(np.concatenate(([False], inside)).astype(np.int8))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.buf = buf
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate(([0], np.searchsorted(self.start, ends)))
        self.count = np.diff(self.first)
        self.hash = _span_hash(buf, self.start, self.end - self.start)

    def __len__(self):
        return len(self.start)

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()


_P = np.uint64(0x9E3779B97F4A7C15)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    p = np.empty(max(n, 1), np.uint64)
    p[0] = 1
    if n > 1:
        p[1:] = _P
    return np.cumprod(p, dtype=np.uint64)


def _span_hash(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes, the spans in rising order and apart."""
    if not len(start):
        return np.empty(0, np.uint64)
    total = int(size.sum())
    rel = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(start, size) + rel
    v = (buf[at].astype(np.uint64) + np.uint64(1)) * _powers(int(size.max()))[rel]
    h = np.add.reduceat(v, np.cumsum(size) - size)
    return mix64(h + size.astype(np.uint64))


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (length n-k+1)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _P + h[i:i + n]
    return mix64(out)


class WordTable:
    """What ``make`` gave for the words a worker met lately.

    Two generations of at most ``most`` words each: when the new one is full
    it becomes the old one, and a word met again moves on, so frequent words
    stay. Words of more than ``LONG`` characters (whole texts without a blank,
    in some scripts) are made each time and not kept, so memory is bounded in
    bytes as well.
    """

    LONG = 64

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most = make, most
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _add(self, word: str) -> bytes:
        if len(word) > self.LONG:
            return self.make(word)
        v = self.new.get(word)
        if v is None:
            v = self.old.get(word)
            if v is None:
                v = self.make(word)
            if len(self.new) >= self.most:
                self.old, self.new = self.new, {}
            self.new[word] = v
        return v

    def get(self, words: list[str]) -> list[bytes]:
        """What each of the words gave."""
        out = list(map(self.new.get, words))
        for i, v in enumerate(out):
            if v is None:
                out[i] = self._add(words[i])
        return out

    def join(self, words: list[str]) -> bytes:
        """What the words gave, one after the other."""
        return b"".join(self.get(words))
