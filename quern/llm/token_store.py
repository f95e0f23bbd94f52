"""Token ids in a binary format with Elias-Fano document boundaries.

A segment is one byte string:

    magic "QTS1" | n_docs u64 | n_ids u64 | low_bits u8 | id_bytes u8 | 6 zero bytes
    | low part | high part | select samples (u32 each) | ids (little-endian)

The rising sequence of document ends (n_docs numbers up to n_ids) is stored
Elias-Fano: the low ``l = floor(log2(n_ids / n_docs))`` bits of each packed
side by side, the rest as a unary bit vector of at most ``2 * n_docs`` bits.
``select`` samples (the place of every 512th one bit) find the i-th one bit,
hence the i-th end, without a table of 64-bit offsets: about 2 + l bits a
document. Ids take two bytes where the vocabulary has at most 65,536.

The writer range-sorts documents by id, encodes them in that order, and
writes segments of bounded size as rows of a table (Spark's committer keeps
a file whole when a task is repeated or an executor lost); the reader
decodes segments on their own. The ids before a segment come from a prefix
sum over partitions, one row each.

Nulls: a null text counts as empty (the end id alone). Rows without doc_id
come first; rows that share a doc_id are ordered by their text. An empty
table gives an empty store. Extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import WordTable, map_arrow, pieces_of
from quern.session import checkpoint_dir

MAGIC = b"QTS1"
HEAD = struct.Struct("<4sQQBB6x")
SAMPLE = 512
#: Ids in a segment before the next begins (a longer document has its own).
SEGMENT_IDS = 2_000_000
#: Words of each generation that a worker remembers.
MOST_WORDS = 350_000


# --- the format ---------------------------------------------------------

def _pack_low(ends: np.ndarray, l: int) -> bytes:
    if not l:
        return b""
    bits = ((ends[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def pack(lengths: np.ndarray, ids: np.ndarray, id_bytes: int) -> bytes:
    """One segment from the lengths of its documents and their joined ids."""
    ends = np.cumsum(lengths).astype(np.uint64)
    n, total = len(ends), len(ids)
    l = max(0, (total // n).bit_length() - 1) if n else 0
    high = (ends >> np.uint64(l)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    bits[high] = 1
    vector = np.packbits(bits, bitorder="little")
    samples = high[::SAMPLE].astype("<u4")
    return b"".join((HEAD.pack(MAGIC, n, total, l, id_bytes), struct.pack("<Q", len(vector)), _pack_low(ends, l),
                     vector.tobytes(), samples.tobytes(), ids.astype(f"<u{id_bytes}").tobytes()))


class Segment:
    """Reads one segment: ``bounds(i)`` by select, ``ids_of(i)`` by slice."""

    def __init__(self, data: bytes):
        magic, self.n_docs, self.n_ids, self.low_bits, width = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        n_high = struct.unpack_from("<Q", data, HEAD.size)[0]
        at = HEAD.size + 8
        n_low = (self.n_docs * self.low_bits + 7) >> 3
        n_samples = -(-self.n_docs // SAMPLE)
        self.low = np.frombuffer(data, np.uint8, n_low, at)
        self.high = np.frombuffer(data, np.uint8, n_high, at := at + n_low)
        self.samples = np.frombuffer(data, "<u4", n_samples, at := at + n_high)
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at + 4 * n_samples)

    def select(self, i: np.ndarray) -> np.ndarray:
        """Positions of the i-th one bits (``i`` rising): each from the sample before it, at most 511 ones on."""
        block = i // SAMPLE
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        out = np.empty(len(i), np.int64)
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(i)]):
            k = int(block[lo])
            at = int(self.samples[k])
            stop = (int(self.samples[k + 1]) >> 3) + 1 if k + 1 < len(self.samples) else len(self.high)
            ones = np.flatnonzero(np.unpackbits(self.high[at >> 3:stop], bitorder="little")[at & 7:])
            out[lo:hi] = at + ones[i[lo:hi] % SAMPLE]
        return out

    def ends(self, i: np.ndarray | None = None) -> np.ndarray:
        """The ends of documents ``i`` (rising; all by default), by select and their low bits."""
        i = np.arange(self.n_docs) if i is None else i
        high = (self.select(i) - i) << self.low_bits
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return high | (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def end(self, i: int) -> int:
        return int(self.ends(np.array([i]))[0])

    def bounds(self, i: int) -> tuple[int, int]:
        return self.end(i - 1) if i else 0, self.end(i)

    def ids_of(self, i: int) -> np.ndarray:
        lo, hi = self.bounds(i)
        return self.ids[lo:hi]


# --- encoding -----------------------------------------------------------

#: Words that the ranked merges take: lower-case letters, digits and signs of ASCII, and these letters.
_PLAIN = re.compile(r"[!-@\[-~\u00df-\u00ff]+")
_ENCODERS: dict[int, WordEncoder] = {}
#: Characters of text whose words are looked up at once.
BATCH_CHARS = 8_000_000


class WordEncoder:
    """Ids of whole texts as the tokenizers library gives them, a batch of texts at a time.

    The vocabulary's tokens never cross white space, so a text is the words
    between its blanks. Arrow splits a batch and finds its distinct words;
    each is encoded once, and ids are gathered by word. A word of plain
    letters and signs goes to its pre-tokens and then to the merges by rank
    (tiktoken; a pre-token's last byte has a symbol of its own, as it bears
    the end mark). Any other word (marks, other scripts, special tokens) goes
    through the whole library. What a word gave is kept for later batches.
    """

    def __init__(self, spec: str):
        import json
        import regex
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        conf = json.loads(spec)
        steps = conf["normalizer"]["normalizers"]
        split, level = conf["pre_tokenizer"]["pretokenizers"]
        if ([s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split"
                or level["type"] != "ByteLevel" or level["add_prefix_space"] or not split["invert"]):
            raise ValueError("not a lower-case tokenizer that drops white space")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.words = WordTable(lambda w: np.array(self._word(w), f"<u{self.width}").tobytes(), MOST_WORDS)
        # Symbols of the plain bytes, and of the same bytes at an end.
        plain = [b for b in range(256) if _PLAIN.fullmatch(chr(b)) and b < 0x7F] + [0xC3, *range(0x9F, 0xC0)]
        self.inner = bytes.maketrans(bytes(plain), bytes(range(len(plain))))
        self.last = {b: bytes([len(plain) + i]) for i, b in enumerate(plain)}
        byte_of = {c: b for b, c in _byte_chars().items()} | {chr(b): b for b in range(256) if b not in _byte_chars()}
        suffix, ranks = conf["model"]["end_of_word_suffix"], {}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in conf["model"]["merges"]]
        vocab = conf["model"]["vocab"]
        made = [vocab["".join(m)] for m in pairs]
        if made != sorted(made):
            raise ValueError("merges out of the order of their ids")
        for token, i in vocab.items():
            ends = token.endswith(suffix) and token != suffix
            raw = [byte_of.get(c) for c in (token[:-len(suffix)] if ends else token)]
            if all(b in self.last for b in raw):
                data = bytes(raw).translate(self.inner)
                ranks[data[:-1] + self.last[raw[-1]] if ends else data] = i
        self.free = max(vocab.values()) + 1
        for b in range(256):  # symbols that no plain word has
            ranks.setdefault(bytes([b]), self.free + b)
        self.merge = tiktoken.Encoding("ranks", pat_str="x", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def _word(self, word: str) -> list[int]:
        low = word.lower()
        if "<|" in word or not _PLAIN.fullmatch(low) or not _PLAIN.fullmatch(word.swapcase().lower()):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for t in (low,) if low.isalpha() else self.pattern.findall(low):
            raw = t.encode()
            out += self.merge(raw[:-1].translate(self.inner) + self.last[raw[-1]])
        return out

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, joined, and how many each has."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        found = lists.flatten().dictionary_encode()
        given = self.words.get(found.dictionary.to_pylist())
        sizes = np.array([len(x) // self.width for x in given], np.int64)
        begins = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(given), f"<u{self.width}")
        at = found.indices.to_numpy()
        n = sizes[at]
        ids = flat[np.repeat(begins[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        total = np.concatenate(([0], np.cumsum(n)))
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return ids, np.diff(total[offsets])

    def encode(self, text: str) -> bytes:
        return self.encode_many(pa.array([text], pa.string()))[0].tobytes()


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


def word_encoder(spec: str) -> WordEncoder:
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(spec)
    return _ENCODERS[key]


# --- the store ----------------------------------------------------------

SEGMENTS = "part int, seg int, ids_before bigint, n_ids bigint, doc_ids array<bigint>, data binary"


def _writer(spec_b, end_id: int, segment_ids: int):
    def make():
        enc = word_encoder(spec_b.value)
        end = np.array([end_id], f"<u{enc.width}").tobytes()
        part, state = TaskContext.get().partitionId(), {"seg": 0, "before": 0}

        def flush(docs, blobs):
            lengths = np.array([len(x) // enc.width for x in blobs], np.int64)
            ids = np.frombuffer(b"".join(blobs), f"<u{enc.width}")
            row = [part, state["seg"], state["before"], len(ids), docs, pack(lengths, ids, enc.width)]
            state["seg"] += 1
            state["before"] += len(ids)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                              names=["part", "seg", "ids_before", "n_ids", "doc_ids", "data"])

        def step(b: pa.RecordBatch):
            docs, blobs, size = [], [], 0
            sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy() + 1
            for lo, hi in pieces_of(sizes, BATCH_CHARS):
                ids, counts = enc.encode_many(b.column("text")[lo:hi])
                at = 0
                for doc, n in zip(b.column("doc_id")[lo:hi].to_pylist(), counts.tolist()):
                    if docs and size + n + 1 > segment_ids:
                        yield flush(docs, blobs)
                        docs, blobs, size = [], [], 0
                    docs.append(doc)
                    blobs.append(ids[at:at + n].tobytes() + end)
                    at += n
                    size += n + 1
            if docs:
                yield flush(docs, blobs)
        return step
    return make


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, partitions: int | None = None,
          segment_ids: int = SEGMENT_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode the texts of ``df`` and write their store at ``path``, in rising id order."""
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # a fixed vocabulary file of a few MB
        spec_b = spark.sparkContext.broadcast(f.read())
    d = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ties = F.xxhash64("text")
    d = d.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), ties).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), ties)
    map_arrow(d, _writer(spec_b, end_id, segment_ids), SEGMENTS).write.option("compression", "zstd").parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a store with ``first``: the ids of all documents before them."""
    s = spark.read.schema(SEGMENTS).parquet(path)
    per_part = s.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a partition, a number the writer chose: small enough to send to all, so segments stay where they are.
    return s.join(F.broadcast(per_part.select("part", before.alias("_base"))), "part").select(
        "part", "seg", (F.col("_base") + F.col("ids_before")).alias("first"), "n_ids", "doc_ids", "data")


def _reader():
    def step(b: pa.RecordBatch):
        for first, docs, data in zip(b.column("first").to_pylist(), b.column("doc_ids"), b.column("data")):
            seg = Segment(data.as_py())
            if len(docs) != seg.n_docs:
                raise ValueError("a segment's document list doesn't fit its boundaries")
            ends = seg.ends()
            starts = np.concatenate(([0], ends[:-1]))
            wide = seg.ids.astype("<u4")
            crc = [zlib.crc32(wide[lo:hi].tobytes()) for lo, hi in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [docs.values, pa.array(starts + first), pa.array(ends - starts), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return step


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of a store."""
    return map_arrow(segments(spark, path).select("first", "doc_ids", "data"), _reader,
                     "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def new_path(spark: SparkSession) -> str:
    import uuid
    return f"{checkpoint_dir(spark)}/llm/tokens-{uuid.uuid4().hex}"
