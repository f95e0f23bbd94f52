"""Skew-safe ordered positions and running sums inside groups.

``row_number() over (partition by g order by o)`` sorts a whole group in
one task; with a group that holds a third of all rows that task is the
job.  Here the order column is cut into buckets of bounded width:

1. per (group, bucket) totals — a hash aggregate with map-side combine;
2. per group, an exclusive running total over its *buckets* (a window
   whose partition has one row per non-empty bucket, not one per row);
3. inside each (group, bucket) a local running value — a window whose
   partition holds at most ``width`` distinct order values;
4. position = bucket offset + local position (an equi-join on
   (group, bucket), which spreads a hot group over all its buckets).

The result is exact, not sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

DEFAULT_WIDTH = 1 << 20


def running_sums(df: DataFrame, group: str | list[str], order: str, values: dict,
                 width: int = DEFAULT_WIDTH, bucket=None, tiebreak: str | None = None) -> DataFrame:
    """Running sums (the row included) of several values inside ``group``
    ordered by ``order`` (then ``tiebreak``), in one pass.

    ``values`` maps output columns to summed columns or expressions.
    ``bucket`` overrides the bucket expression (default ``floor(order / width)``
    for an integral ``order``; pass e.g. a time bucket for timestamps).
    """
    groups = [group] if isinstance(group, str) else list(group)
    b = bucket if bucket is not None else F.floor(F.col(order) / F.lit(width))
    x = df.withColumns({"_b": b, **{f"_v_{o}": (F.col(v) if isinstance(v, str) else v).cast("bigint") for o, v in values.items()}})
    tot = x.groupBy(*groups, "_b").agg(*[F.sum(f"_v_{o}").alias(f"_t_{o}") for o in values])
    wb = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*groups, "_b", *[F.coalesce(F.sum(f"_t_{o}").over(wb), F.lit(0)).alias(f"_off_{o}") for o in values])
    frame = (Window.partitionBy(*groups, "_b").orderBy(*[order] + ([tiebreak] if tiebreak else []))
             .rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumns({f"_l_{o}": F.coalesce(F.sum(f"_v_{o}").over(frame), F.lit(0)) for o in values}).join(offs, groups + ["_b"])
    x = x.withColumns({o: F.col(f"_off_{o}") + F.col(f"_l_{o}") for o in values})
    return x.drop("_b", *[f"_{k}_{o}" for o in values for k in ("v", "off", "l")])


def running_sum(df: DataFrame, group: str | list[str], order: str, value, out: str,
                inclusive: bool = True, width: int = DEFAULT_WIDTH,
                bucket=None, tiebreak: str | None = None) -> DataFrame:
    """:func:`running_sums` of one value, with or without the row itself."""
    v = F.col(value) if isinstance(value, str) else value
    x = running_sums(df, group, order, {out: v}, width, bucket, tiebreak)
    return x if inclusive else x.withColumn(out, F.col(out) - F.coalesce(v.cast("bigint"), F.lit(0)))


def rank_in_group(df: DataFrame, group: str | list[str], order: str, out: str = "_rank",
                  width: int = DEFAULT_WIDTH, bucket=None, tiebreak: str | None = None) -> DataFrame:
    """0-based position of each row inside its group by ``order``."""
    return running_sum(df, group, order, F.lit(1), out, inclusive=False, width=width,
                       bucket=bucket, tiebreak=tiebreak)
