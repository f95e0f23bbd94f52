"""A prefix trie of rebuilt conversations from composable fingerprints.

A conversation is rebuilt as the first turns of a base conversation followed
by its own turns after its first few. No rebuilt text is ever made. Every
stored turn has a value, and a run of turns is an element (length, hash) of a
monoid: (n, v) · (m, w) = (n + m, v + B^n w) modulo a prime, for three bases
at once. Prefix products of the stored conversations come from one ordered
pass: products inside a sorted partition, and the product of the partitions
before it. A rebuilt prefix is then the base's product of its head, times the
own prefix with its first turns taken off and moved to the head's length;
a shift by at most three powers of B.

A node is a group of rebuilt prefixes of one length and one fingerprint.
Equality is verified, not assumed. Every prefix row points to its last turn,
as it is stored (turn_conv_id, turn_pos); turns of one value must be one text,
and all rows of a group must come from one parent group and end in one turn
value. By induction over the depth their turns are then equal. Where a check
fails, the trie is built again with other values and bases.

No step walks the trie level by level. Of the conversations that run through
a node the smallest names it; along a conversation these names rise, so from
some depth on (its branch) a conversation names its own nodes. Leaves and
savings of a subtree are then sums over the conversations that run through
its top: each brings what its own nodes below its branch hold. Sums and
counts are pre-aggregated; a node that a third of all conversations share is
first aggregated in salted shares, and a conversation with a third of all
turns is spread by the partitions of its ordered pass. The ids that end at a
node are joined in stretches of bounded size, and hashed in a stream.

Nulls: rows without conv_id take no part; null turns come first; null role or
text is empty. Rows of one conversation and turn go in order of role, then
text; repeated rows are turns of their own. A conversation whose rebuilt form
has no turn is a member of the root. Texts may have any length. An empty
table gives an empty trie; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import shared_table
from quern.operators.ranking import running_sum
from quern.session import ship_package

#: Primes below 2**31, so that products fit a long.
PRIMES = (2147483647, 2147483629, 2147483587)
#: The longest head, and shares in which a group of rows is aggregated first.
MOST_HEAD, SALTS = 4, 32
#: Bytes of joined ids in one stretch.
STRETCH = 4096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Bases:
    """The values of turns and the bases of one attempt, drawn by ``seed``."""

    def __init__(self, seed: int):
        self.seed = seed
        self.b = [random.Random(f"{seed}/{p}").randrange(p // 3, p - 1) for p in PRIMES]

    def value(self, j: int) -> Column:
        """The j-th value of a turn, from 1 up."""
        return F.pmod(F.xxhash64(F.lit(self.seed * 8 + j), "role", "text"), F.lit(PRIMES[j] - 1)) + 1

    def power(self, j: int, n: Column) -> Column:
        """B^n modulo the j-th prime for n from 0 to 2**32, by its hexadecimal digits."""
        out = None
        for k in range(8):
            table = F.expr("array(%s)" % ", ".join(f"{pow(self.b[j], i * 16 ** k, PRIMES[j])}L" for i in range(16)))
            x = F.get(table, F.shiftright(n, 4 * k).bitwiseAND(F.lit(15)).cast("int"))
            out = x if out is None else out * x % PRIMES[j]
        return out

    def small_power(self, j: int, n: Column) -> Column:
        """B^n for n from -MOST_HEAD to MOST_HEAD."""
        table = F.array(*[F.lit(pow(self.b[j], i, PRIMES[j])).cast("bigint") for i in range(-MOST_HEAD, MOST_HEAD + 1)])
        return F.get(table, (n + MOST_HEAD).cast("int"))


JS = range(len(PRIMES))


def base_of(c: Column) -> Column:
    """The rule of the query: the conversation whose head is taken."""
    return c - c % 20


def head_of(c: Column) -> Column:
    """The rule of the query: how many turns of it."""
    return (F.crc32(c.cast("string").cast("binary")) % 4).cast("bigint")


def ordered_turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text in order, with ``mid`` rising, written to the shared folder."""
    d = df.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                  F.coalesce(F.col("text"), F.lit("")).alias("text")).filter(F.col("conv_id").isNotNull())
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
    # The first characters of a text order it as far as partitions go; the sort reads it whole.
    d = d.repartitionByRange(parts, *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    return shared_table(d.withColumn("mid", F.monotonically_increasing_id()), "turns")


def _prefix_products(turns: DataFrame, bases: Bases) -> DataFrame:
    """Of every stored turn: conv_id, part, pos (from 0), words, turn value ids t0.., and V0..: the product up to it."""
    part = F.shiftrightunsigned("mid", 33).cast("int")
    x = turns.select("conv_id", part.alias("part"), "mid", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
                     *[bases.value(j).alias(f"t{j}") for j in JS])
    run = Window.partitionBy("conv_id", "part").orderBy("mid")
    x = x.withColumn("i", F.row_number().over(run).cast("bigint") - 1)
    local = run.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"l{j}": F.sum(F.col(f"t{j}") * bases.power(j, F.col("i")) % PRIMES[j]).over(local) % PRIMES[j] for j in JS})
    x = shared_table(x.drop("mid"), "products")
    # Products of the runs before, one row a run: the monoid again.
    runs = x.groupBy("conv_id", "part").agg(F.count("*").alias("n"), *[F.max_by(f"l{j}", "i").alias(f"r{j}") for j in JS])
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    runs = runs.select("conv_id", "part", "at", *[
        F.coalesce(F.sum(F.col(f"r{j}") * bases.power(j, F.col("at")) % PRIMES[j]).over(before) % PRIMES[j], F.lit(0)).alias(f"c{j}")
        for j in JS])
    x = x.join(runs, ["conv_id", "part"])
    return x.select("conv_id", "part", (F.col("at") + F.col("i")).alias("pos"), "words", *[f"t{j}" for j in JS], *[
        ((F.col(f"c{j}") + bases.power(j, F.col("at")) * F.col(f"l{j}")) % PRIMES[j]).alias(f"V{j}") for j in JS])


PREFIX = ["conv_id", "part", "depth", *[f"f{j}" for j in JS], *[f"p{j}" for j in JS], *[f"t{j}" for j in JS], "words",
          "turn_conv_id", "turn_pos"]


def rebuilt_prefixes(products: DataFrame, bases: Bases, base, head) -> tuple[DataFrame, DataFrame]:
    """Every prefix of every rebuilt conversation with its fingerprint, and (conv_id, n_turns) of each.

    A row holds its fingerprint f, its parent's p, its last turn's value t, and where that turn is stored.
    """
    first = F.struct("pos", *[f"V{j}" for j in JS], *[f"t{j}" for j in JS], "words")
    convs = products.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") < MOST_HEAD, first))).alias("firsts"))  # four at most
    heads = convs.select(F.col("conv_id").alias("base_id"), F.col("firsts").alias("base_firsts"))
    c = convs.withColumns({"b": base(F.col("conv_id")), "h": head(F.col("conv_id"))})
    c = c.join(heads, F.col("b") == F.col("base_id"), "left").withColumn("base_firsts", F.coalesce(
        "base_firsts", F.slice("firsts", 1, 0)))  # an absent base has no turn
    c = c.withColumn("hl", F.least("h", F.size("base_firsts")).cast("bigint"))

    def product(firsts: str, n: Column, j: int) -> Column:
        """The product of the first n turns kept in ``firsts``."""
        return F.when(n == 0, F.lit(0).cast("bigint")).otherwise(F.get(F.col(firsts), (n - 1).cast("int"))[f"V{j}"])

    own = F.least("h", "n")
    c = shared_table(c.select(
        "conv_id", "n", "b", "h", "hl", F.slice("base_firsts", 1, F.col("hl").cast("int")).alias("head"),
        (F.col("hl") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"),
        *[product("base_firsts", F.col("hl"), j).alias(f"H{j}") for j in JS],
        *[product("firsts", own, j).alias(f"O{j}") for j in JS]), "rebuilt")
    # The head's prefixes: the base's own products.
    h = c.filter("hl > 0").select("conv_id", "b", "head", F.posexplode("head").alias("i", "x"))
    heads = h.select(
        "conv_id", F.lit(-1).alias("part"), (F.col("i") + 1).cast("bigint").alias("depth"),
        *[F.col("x")[f"V{j}"].alias(f"f{j}") for j in JS],
        *[F.when(F.col("i") == 0, F.lit(0).cast("bigint")).otherwise(F.get("head", F.col("i") - 1)[f"V{j}"]).alias(f"p{j}") for j in JS],
        *[F.col("x")[f"t{j}"].alias(f"t{j}") for j in JS], F.col("x.words").alias("words"),
        F.col("b").alias("turn_conv_id"), F.col("x.pos").alias("turn_pos"))
    # The own suffix: the head's product times the suffix's, moved from place h to place hl.
    spans = products.select("conv_id", "part").distinct().join(
        c.select("conv_id", "h", "hl", *[f"H{j}" for j in JS], *[f"O{j}" for j in JS]), "conv_id")
    x = products.join(spans, ["conv_id", "part"]).filter("pos >= h")
    shift = F.col("hl") - F.col("h")

    def moved(v: Column, j: int) -> Column:
        return (F.col(f"H{j}") + bases.small_power(j, shift) * F.pmod(v - F.col(f"O{j}"), F.lit(PRIMES[j]))) % PRIMES[j]

    def before(j: int) -> Column:
        return F.pmod(F.col(f"V{j}") - F.col(f"t{j}") * bases.power(j, F.col("pos")) % PRIMES[j], F.lit(PRIMES[j]))

    tails = x.select(
        "conv_id", "part", (F.col("hl") + F.col("pos") - F.col("h") + 1).alias("depth"),
        *[moved(F.col(f"V{j}"), j).alias(f"f{j}") for j in JS], *[moved(before(j), j).alias(f"p{j}") for j in JS],
        *[f"t{j}" for j in JS], "words", F.col("conv_id").alias("turn_conv_id"), F.col("pos").alias("turn_pos"))
    zero = F.lit(0).cast("bigint")
    root = c.select("conv_id", F.lit(-2).alias("part"), zero.alias("depth"), *[zero.alias(f"{a}{j}") for a in "fpt" for j in JS],
                    zero.alias("words"), F.lit(None).cast("bigint").alias("turn_conv_id"), F.lit(None).cast("bigint").alias("turn_pos"))
    rows = root.select(PREFIX).unionAll(heads.select(PREFIX)).unionAll(tails.select(PREFIX))
    return shared_table(rows, "prefixes"), c.select("conv_id", "n_turns")


class Unequal(Exception):
    """A fingerprint stood for two different sequences."""


def _verify_turns(turns: DataFrame, bases: Bases) -> None:
    """Turns of one value are one text (every text of a value is read)."""
    texts = turns.select(*[bases.value(j).alias(f"t{j}") for j in JS], "role", "text").distinct()
    if not texts.groupBy(*[f"t{j}" for j in JS]).count().filter("count > 1").isEmpty():
        raise Unequal


NODE = ["depth", *[f"f{j}" for j in JS]]


def _nodes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every prefix row with its node: ``rep`` (smallest member), n_convs and n_ends.

    Aggregated in salted shares first, and handed back by share, so that no task gets a whole popular node.
    """
    x = rows.join(lengths.select(F.col("conv_id").alias("_c"), "n_turns"), (F.col("conv_id") == F.col("_c")) & (F.col("depth") == F.col("n_turns")), "left")
    x = x.select(*PREFIX, F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int").alias("salt"), F.col("_c").isNotNull().cast("bigint").alias("ends"))
    same = [f"{a}{j}" for a in "pt" for j in JS]
    share = x.groupBy(*NODE, "salt").agg(F.count("*").alias("n"), F.min("conv_id").alias("rep"), F.sum("ends").alias("e"),
                                         *[F.min(s).alias(f"lo_{s}") for s in same], *[F.max(s).alias(f"hi_{s}") for s in same])
    share = shared_table(share, "shares")
    node = share.groupBy(*NODE).agg(F.sum("n").alias("n_convs"), F.min("rep").alias("rep"), F.sum("e").alias("n_ends"),
                                    *[F.min(f"lo_{s}").alias(f"lo_{s}") for s in same], *[F.max(f"hi_{s}").alias(f"hi_{s}") for s in same])
    node = shared_table(node, "nodes")
    if not node.filter(" OR ".join(f"lo_{s} <> hi_{s}" for s in same)).isEmpty():
        raise Unequal
    named = share.select(*NODE, "salt").join(node.select(*NODE, "n_convs", "rep", "n_ends"), NODE)
    x = x.join(named, [*NODE, "salt"])
    return shared_table(x.select("conv_id", "part", "depth", "words", "turn_conv_id", "turn_pos", "rep", "n_convs", "n_ends", "ends"), "named")


def _ends_digest(ends: DataFrame) -> DataFrame:
    """(rep, depth, ends_sha256): the joined ids of the conversations that end at each node."""
    spark = ends.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["rep", "depth", "conv_id"]

    def stretch(batches):
        """Runs of ids of one node, up to STRETCH bytes."""
        for b in batches:
            rows, key, text = [], None, []
            size = 0
            for rep, depth, c in zip(*(b.column(k).to_pylist() for k in by)):
                if key is None or (rep, depth) != key[:2] or size > STRETCH:
                    if key is not None:
                        rows.append((*key, ",".join(text)))
                    key, text, size = (rep, depth, c), [], 0
                text.append(str(c))
                size += len(text[-1]) + 1
            if key is not None:
                rows.append((*key, ",".join(text)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                                 names=["rep", "depth", "first", "ids"])

    def digest(batches):
        """SHA-256 over each node's stretches, which come in order; one node's state is held at a time."""
        key, sha = None, None
        for b in batches:
            done = []
            for rep, depth, ids in zip(*(b.column(k).to_pylist() for k in ("rep", "depth", "ids"))):
                if (rep, depth) == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (rep, depth), hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield _digests(done)
        if key is not None:
            yield _digests([(*key, sha.hexdigest())])

    def _digests(done):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string()))],
                                          names=["rep", "depth", "ends_sha256"])

    runs = (ends.select(*by).repartitionByRange(parts, *by).sortWithinPartitions(*by)
            .mapInArrow(stretch, "rep bigint, depth bigint, first bigint, ids string"))
    return (runs.repartition(parts, "rep", "depth").sortWithinPartitions("rep", "depth", "first").select("rep", "depth", "ids")
            .mapInArrow(digest, "rep bigint, depth bigint, ends_sha256 string"))


def _trie(turns: DataFrame, bases: Bases, base, head) -> DataFrame:
    _verify_turns(turns, bases)
    rows, lengths = rebuilt_prefixes(_prefix_products(turns, bases), bases, base, head)
    x = _nodes(rows, lengths)
    # Of every conversation: where its own nodes begin, whose node that branches from, and what it brings.
    own = F.col("rep") == F.col("conv_id")
    saved = (F.col("n_convs") - 1) * F.col("words")
    convs = shared_table(x.groupBy("conv_id").agg(
        F.sum(F.when(own, 0).otherwise(1)).alias("branch"), F.max(F.when(~own, F.col("rep"))).alias("from_id"),
        F.max("depth").alias("n_turns"), F.sum(F.when(own, saved).otherwise(0)).alias("brings"),
        F.max(F.when(own & (F.col("ends") == 1) & (F.col("n_ends") == F.col("n_convs")), 1).otherwise(0)).alias("leaf")), "branches")
    spans = x.select("conv_id", "part").distinct().join(convs, "conv_id")
    # What the conversations that share a node without naming it bring to its subtree.
    guests = x.filter(~own).select("conv_id", "part", "depth", "rep").join(spans, ["conv_id", "part"])
    guests = guests.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)))
    sums = lambda: [F.sum(c).alias(c) for c in ("g_saved", "g_leaves", "g_children")]
    guests = (guests.select("rep", "depth", "salt", F.col("brings").alias("g_saved"), F.col("leaf").cast("bigint").alias("g_leaves"),
                            ((F.col("branch") == F.col("depth") + 1) & (F.col("n_turns") > F.col("depth"))).cast("bigint").alias("g_children"))
              .groupBy("rep", "depth", "salt").agg(*sums()).groupBy("rep", "depth").agg(*sums()))
    # A conversation's own nodes: what it has saved from this depth on.
    nodes = x.filter(own).join(spans.select("conv_id", "part", "branch", "from_id", F.col("n_turns").alias("len"), "leaf", "brings"), ["conv_id", "part"])
    nodes = running_sum(nodes, "conv_id", "depth", saved, "saved_before", inclusive=False, width=1 << 16)
    n = nodes.join(guests, ["rep", "depth"], "left").na.fill(0, ["g_saved", "g_leaves", "g_children"])
    n = n.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.when(F.col("depth") > F.col("branch"), F.col("conv_id")).otherwise(F.col("from_id"))).alias("parent_conv_id"),
        "n_convs", (F.col("g_children") + (F.col("len") > F.col("depth")).cast("bigint")).alias("n_children"),
        (F.col("g_leaves") + F.col("leaf")).alias("n_leaves"), (F.col("brings") - F.col("saved_before") + F.col("g_saved")).alias("saved_tokens"),
        "n_ends", "turn_conv_id", "turn_pos")
    shas = _ends_digest(x.filter("ends = 1")).withColumnRenamed("rep", "conv_id")
    n = n.join(shas, ["conv_id", "depth"], "left")
    return n.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "n_ends",
        "turn_conv_id", "turn_pos")


def trie(df: DataFrame, base=base_of, head=head_of, attempts=(Bases(1), Bases(2), Bases(3), Bases(4))) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256,
    n_ends, and where its last turn is stored (turn_conv_id, turn_pos).

    ``base`` and ``head`` give, for a conv_id, the conversation whose head is taken and how many turns of it
    (at most ``MOST_HEAD``).
    """
    turns = ordered_turns(df)
    for bases in attempts:
        try:
            return _trie(turns, bases, base, head)
        except Unequal:
            continue
    raise ValueError("no attempt told all sequences apart")


ORACLE = """
WITH RECURSIVE crc(conv_id, h) AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END))) % 4
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
  SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
stored AS (SELECT conv_id, list(t ORDER BY pos) AS ts FROM turns GROUP BY 1),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.ts, [])[1:h], s.ts[h + 1:]) AS ts
  FROM stored s JOIN crc USING (conv_id) LEFT JOIN stored b ON b.conv_id = s.conv_id - s.conv_id % 20),
prefixes AS (SELECT conv_id, d AS depth, ts[1:d] AS p, len(ts) = d AS ends FROM rebuilt, unnest(range(0, len(ts) + 1)) AS u(d)),
nodes AS (
  SELECT min(conv_id) AS conv_id, depth, p, count(*) AS n_convs, count(*) FILTER (ends) AS n_ends,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[depth][2], '[^\\x20\\x09-\\x0D]+')) END AS own
  FROM prefixes GROUP BY depth, p),
kids AS (SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
up AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (depth, p)),
below AS (
  SELECT d AS depth, p[1:d] AS p, sum(own) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM up, unnest(range(0, depth + 1)) AS u(d) GROUP BY ALL)
SELECT u.conv_id, u.depth, q.conv_id AS parent_conv_id, u.n_convs, u.n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
       u.ends_sha256, u.n_ends
FROM up u JOIN below b ON b.depth = u.depth AND b.p = u.p LEFT JOIN nodes q ON q.depth = u.depth - 1 AND q.p = u.p[1:u.depth - 1]
"""
