"""Mixing sources to target weights by a time-varying curriculum.

Training time runs from 0 to 1. Each source has a weight schedule, a
piecewise linear intensity over time. Its integral is scaled to the
source's target, which gives the source's cumulative token demand as a
rising function of time; the words of the source, laid end to end in the
order of a hash, are placed where that function reaches them (its inverse,
a quadratic within each piece). Documents are range-sorted by position.

Targets: the sources share the total by weight; none takes more than
``most`` times its size, and what is left over is shared again by weight
among the others until none is above.

A source asked for more than it has is read again, in the same order: each
reading of a document is a *visit* with a position of its own. The words
taken of a source add up to its target rounded down; the document in which
that point falls is visited for its first words' worth of demand.

Order inside a source is by the hash of id and text, cut into as many
buckets as a bucket has rows (the root of the source's row count), so no
source is sorted in one task: bucket totals, a running total over buckets,
and a window inside each bucket.

Nulls: a null source is a source of its own (the last); a null text has
size 0 and takes 0 words. Repeated rows are laid side by side, in any
order alike. An empty table, or one without words, gives targets of 0.
Extra columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import free_name, shared_table

MOST = 3

#: Weight schedules as (time, intensity) knots, dealt to the sources in turn.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),             # fades
    ((0.0, 1.0), (1.0, 1.0)),             # steady
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),  # grows
)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``sizes`` (source, n, source_size) plus ``rank``, ``weight`` and ``target``.

    One row per source. The sources at their ceiling are those with the
    least size per weight, so "share again until none is above" is the
    first point of that order where the rest fit. All sums are whole
    numbers; the target is one division.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight.cast("long"))
    # In order of size per weight: what is left and the weights left before each source.
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy()
    s = (s.withColumn("_left", F.sum("source_size").over(all_) - F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0)))
         .withColumn("_weights", F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("_full", F.col("_left") * F.col("weight") > most * F.col("source_size") * F.col("_weights")))
    # The first source that isn't full sets the level for itself and all after it.
    level = F.min(F.when(~F.col("_full"), F.struct(F.row_number().over(order).alias("i"), "_left", "_weights"))).over(all_)
    s = s.withColumn("_level", level).withColumn("_i", F.row_number().over(order))
    target = F.when((F.col("_level").isNull()) | (F.col("_i") < F.col("_level.i")), (most * F.col("source_size")).cast("double")).otherwise(
        F.col("_level._left") * F.col("weight") / F.col("_level._weights"))
    return s.select("source", "n", "source_size", "rank", "weight", target.alias("target"))


def _pieces(knots) -> list[tuple[float, float, float, float, float]]:
    """(t0, t1, w0, w1, demand before) of each piece, scaled to a whole demand of 1."""
    out, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        out.append((t0, t1, w0, w1, total))
        total += (w0 + w1) / 2 * (t1 - t0)
    if total <= 0 or any(w < 0 for _, w in knots) or knots[0][0] != 0 or knots[-1][0] != 1:
        raise ValueError("a schedule needs rising times from 0 to 1 and a positive area")
    return [(t0, t1, w0 / total, w1 / total, d / total) for t0, t1, w0, w1, d in out]


def position(share: Column, schedule: Column, schedules=SCHEDULES) -> Column:
    """The time at which the given schedule's demand reaches ``share`` (0 to 1) of its whole."""
    out = F.lit(None).cast("double")
    for i, knots in enumerate(schedules):
        t = F.lit(1.0)
        for t0, t1, w0, w1, before in reversed(_pieces(knots)):
            need = F.greatest(share - F.lit(before), F.lit(0.0))
            slope = (w1 - w0) / (t1 - t0)
            # w0 x + slope x^2 / 2 = need, in the form that also holds for slope 0
            x = 2 * need / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))))
            x = F.when(need <= 0, F.lit(0.0)).otherwise(x)
            end = before + (w0 + w1) / 2 * (t1 - t0)
            t = F.when(share <= end, F.least(F.lit(t0) + x, F.lit(t1))).otherwise(t)
        out = F.when(schedule == i, t).otherwise(out)
    return out


def assign(df: DataFrame, most: int = MOST, weights: tuple[int, ...] = (1, 2, 3), schedules=SCHEDULES,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", out: str = "mix") -> DataFrame:
    """``df`` plus the struct ``out`` (``mix``): size, source_size, target, taken and visits (position, words) of each row."""
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(source_col).alias("source"),
                    words(F.col(text_col)).alias("size"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    sizes = shared_table(targets(
        df.select(F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
        .groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), most, weights), "sources")
    x = own.join(sizes.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    buckets = F.ceil(F.sqrt("n"))
    x = x.withColumn("bucket", F.pmod("h", buckets))
    totals = x.groupBy("rank", "bucket").agg(F.sum("size").alias("held"))
    run = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("rank").alias("_rank"), F.col("bucket").alias("_bucket"),
                            F.coalesce(F.sum("held").over(run), F.lit(0)).alias("before"))
    inside = Window.partitionBy("rank", "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    x = x.join(offsets, (F.col("rank") == F.col("_rank")) & (F.col("bucket") == F.col("_bucket")))
    start = F.col("before") + F.col("at")
    # Visit v covers the demand from v * source_size + start; what lies beyond the target isn't taken.
    wanted = F.floor("target")
    visit = lambda v: F.greatest(F.least(F.col("size"), wanted - (F.lit(v) * F.col("source_size") + start)), F.lit(0))
    visits = F.filter(F.array(*[F.struct(
        position(F.try_divide(F.lit(v) * F.col("source_size") + start, F.col("target")),
                 F.col("rank") % len(schedules), schedules).alias("position"),
        visit(v).cast("long").alias("words")) for v in range(most)]), lambda s: s["words"] > 0)
    x = x.withColumn("visits", visits)
    taken = F.aggregate("visits", F.lit(0).cast("long"), lambda a, s: a + s["words"])
    return x.select("row.*", F.struct("size", "source_size", "target", taken.alias("taken"), "visits").alias(out))


def curriculum(df: DataFrame, partitions: int | None = None, **options) -> DataFrame:
    """The mix itself: a row of ``df`` for each of its visits, range-sorted by position.

    A document read twice or three times stands there as often.
    """
    mix, visit = free_name(df, "mix"), free_name(df, "_visit")
    rows = assign(df, **options, out=mix)
    cols = [F.col(f"`{c}`") for c in df.columns]
    rows = rows.select(*cols, F.explode(f"{mix}.visits").alias(visit))
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, F.col(f"{visit}.position")).sortWithinPartitions(f"{visit}.position").select(*cols)


def digest(assigned: DataFrame, partitions: int | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, position (of the first visit), range-sorted by it."""
    parts = partitions or int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = assigned.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken",
                          F.try_element_at("mix.visits", F.lit(1))["position"].alias("position"))
    return out.repartitionByRange(parts, F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id")
