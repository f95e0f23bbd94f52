"""Registry of named queries: one Spark builder + one DuckDB oracle each.

``QUERIES[name] = Query(build, sql)`` where ``build(spark, sf_dir)``
returns a DataFrame over the driver tables and ``sql`` is the
independent DuckDB statement (``None`` when the operator is not
SQL-expressible and is tested against brute force instead).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    inventory: str = ""


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None, inventory: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, inventory)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from quern.plans import q_dedup, q_text, q_urls  # noqa: F401
    for mod in ("q_dates", "q_pages", "q_joins", "q_requests", "q_neardup", "q_streaming", "q_sources"):
        try:
            __import__(f"quern.plans.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"quern.plans.{mod}":
                raise
    return QUERIES
