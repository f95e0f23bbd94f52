"""Best-fit packing planned on a histogram of lengths.

Documents are encoded (byte-level BPE, an end id after each), and those
longer than a sequence are cut into pieces of its capacity; what is left
over is the first piece. Best-fit decreasing then runs over counts: the
driver holds how many pieces there are of each length, at most ``capacity``
numbers whatever the corpus, and open sequences as runs of consecutive
numbers with the same room. All pieces of a length go at once: into the
tightest run that holds them, as many to a sequence as fit, else into new
sequences. Every step puts down a slot range (length, ranks, sequences,
offset), and a piece takes its slot by its rank within its length. That is
the packing that best-fit decreasing gives piece by piece, as pieces of one
length are interchangeable.

Ranks need no sort: each encoding task counts its pieces by length, and the
counts of the tasks before it come from a prefix sum over (length, task).
A length that a third of all pieces share is never in one task or group.
The plan has a few rows for every length, so its size is bounded by the
capacity; it is sent to all tasks.

Nulls: a null text counts as empty (the end id alone); a null id stays
null. Repeated rows are documents of their own. Which of the pieces of one
length takes which slot follows from the files' order and may differ between
runs; lengths, ids and the number of sequences don't. Texts of any length are
encoded whole. An empty table gives an empty packing; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, shared_table

CAPACITY = 1024
#: Ids held before a batch of pieces is handed on.
BATCH_IDS = 1_000_000
#: Fixed value: how byte-level BPE of this family cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- encoding -----------------------------------------------------------

_ENCODERS: dict[int, ByteEncoder] = {}
_LONG_BLANK = re.compile(r"\s{2000}")


class ByteEncoder:
    """Ids of whole texts as the tokenizers library gives them.

    The vocabulary's merges stand in the order of the ids they make (checked
    here), so merging by rank is merging by id; tiktoken does that several
    times faster over the same vocabulary. Texts that hold a special token, or
    blanks too many for its pattern, go through the tokenizers library itself.
    """

    def __init__(self, spec: str):
        import json
        import tiktoken
        from tokenizers import Tokenizer
        from quern.llm.token_store import _byte_chars
        conf = json.loads(spec)
        cut, model = conf["pre_tokenizer"], conf["model"]
        if conf["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError("not a plain byte-level vocabulary")
        vocab, pairs = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(vocab["".join(m)] != 256 + i for i, m in enumerate(pairs)):
            raise ValueError("merges out of the order of their ids")
        byte_of = {c: b for b, c in _byte_chars().items()} | {
            chr(b): b for b in range(256) if b not in _byte_chars()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_str(spec)
        self.special = [t["content"] for t in conf["added_tokens"]]

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special) or (len(text) > 2000 and _LONG_BLANK.search(text)):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def byte_encoder(spec: str) -> ByteEncoder:
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = ByteEncoder(spec)
    return _ENCODERS[key]


PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, "
          "part_rank bigint, ids binary")


def _cutter(spec_b, end_id: int, capacity: int):
    def make():
        enc = byte_encoder(spec_b.value)
        part, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)

        def flush(rows):
            cols = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "part_rank", "ids"])

        def step(b: pa.RecordBatch):
            rows, held = [], 0
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = np.append(enc.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                first = len(ids) - capacity * ((len(ids) - 1) // capacity)
                at, to, piece = 0, first, 0
                while at < len(ids):
                    data = ids[at:to].tobytes()
                    rows.append((doc, piece, at, to - at, zlib.crc32(data), part, int(met[to - at]), data))
                    met[to - at] += 1
                    at, to, piece = to, to + capacity, piece + 1
                held += len(ids)
                if held > BATCH_IDS:
                    yield flush(rows)
                    rows, held = [], 0
            if rows:
                yield flush(rows)
        return step
    return make


def pieces(df: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The encoded pieces of every document (``PIECES``; ids as little-endian 32-bit), in the shared folder."""
    with open(tokenizer_path, encoding="utf-8") as f:  # a fixed vocabulary file of a few MB
        spec_b = df.sparkSession.sparkContext.broadcast(f.read())
    d = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return shared_table(map_arrow(d, _cutter(spec_b, end_id, capacity), PIECES), "pieces")


# --- the plan -----------------------------------------------------------

class Slots(NamedTuple):
    """Ranks from ``rank`` on of pieces of ``length``: ``per`` to each of ``n`` sequences from ``sequence``, at ``offset``."""
    length: int
    rank: int
    n: int
    per: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Slots], int]:
    """Slot ranges for ``counts[length]`` pieces of each length, and the number of sequences."""
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> runs (first sequence, how many)
    out: list[Slots] = []
    opened = 0

    def put(length, rank, n, per, sequence, left_before):
        out.append(Slots(length, rank, n, per, sequence, capacity - left_before))
        left = left_before - per * length
        if left:
            room[left].append((sequence, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} in sequences of {capacity}")
        rank, todo = 0, counts[length]
        while todo:
            tight = next((r for r in range(length, capacity) if room.get(r)), None)
            left = capacity if tight is None else tight
            per = left // length
            if tight is None:  # none holds it: open as many as the pieces need
                sequence, n = opened, -(-todo // per)
                opened += n
            else:
                sequence, n = room[tight].pop()
            full = min(n, todo // per)
            if full:
                put(length, rank, full, per, sequence, left)
                rank, todo = rank + full * per, todo - full * per
            if full < n and todo:  # fewer than would fill one more
                put(length, rank, 1, todo, sequence + full, left)
                rank, todo, full = rank + todo, 0, full + 1
            if full < n:
                room[left].append((sequence + full, n - full))
    return out, opened


# --- taking the slots ---------------------------------------------------

def pack(encoded: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``encoded`` (all columns of ``PIECES``) plus sequence_id and offset."""
    spark = encoded.sparkSession
    held = encoded.groupBy("length", "part").agg(F.count("*").alias("n"))
    held = shared_table(held, "lengths")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity``
    slots, _ = plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select(F.col("length").alias("_length"), F.col("part").alias("_part"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = encoded.join(base, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part"))).withColumn(
        "_rank", F.col("_base") + F.col("part_rank"))
    by_length = defaultdict(list)
    for s in slots:
        by_length[s.length].append(tuple(s[1:]))
    kind = "_slot_length bigint, slots array<struct<rank: bigint, n: bigint, per: bigint, sequence: bigint, offset: bigint>>"
    table = spark.createDataFrame(list(by_length.items()), kind)
    # The plan's size is bounded by the capacity, not by the corpus.
    x = ranked.join(F.broadcast(table), F.col("length") == F.col("_slot_length"))
    mine = F.filter("slots", lambda s: (s["rank"] <= F.col("_rank")) & (F.col("_rank") < s["rank"] + s["n"] * s["per"]))[0]
    x = x.withColumn("_slot", F.struct((F.col("_rank") - mine["rank"]).alias("i"), mine.alias("s")))
    i, s = F.col("_slot.i"), F.col("_slot.s")
    return x.select(*encoded.columns, (s["sequence"] + F.expr("_slot.i div _slot.s.per")).alias("sequence_id"),
                    (s["offset"] + i % s["per"] * F.col("length")).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, documents (doc_id, piece, start, length, offset) and ids of every packed sequence."""
    part = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    x = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(part)).alias("p"))
    return x.select("sequence_id", "n_tokens",
                    F.transform("p", lambda s: F.struct(s["doc_id"].alias("doc_id"), s["piece"].alias("piece"), s["start"].alias("start"),
                                                        s["length"].alias("length"), s["offset"].alias("offset"))).alias("documents"),
                    F.aggregate("p", F.lit(b"").cast("binary"), lambda a, s: F.concat(a, s["ids"])).alias("ids"))


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
