"""Small plan helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, **cols: Column) -> DataFrame:
    """Add ``cols`` computed exactly once per row.

    Catalyst collapses adjacent projections by substituting aliases; when a
    large derived value (a cascade of regex extractions) is referenced by
    several later expressions, the substitution copies it into each of
    them, and the generated code grows past what Janino compiles.  A
    one-row ``inline`` is a Generate node, which projections are never
    collapsed into, so later expressions read the computed column.
    """
    s = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.inline(F.array(s)))
