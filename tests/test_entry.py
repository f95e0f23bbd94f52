"""Driver contract: entry runs on sf0.001; every query has a callable; oracles parse."""

import os

import duckdb

import __spark_entry__ as E
from conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "doc_id" in df.columns


def test_registry_and_oracles_prepare():
    qs, sqls = E.queries(), E.oracle_sql()
    assert len(qs) >= 60
    assert set(sqls) <= set(qs)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    for name, sql in sqls.items():
        con.execute(f"EXPLAIN {sql}")  # parses and binds


def _values(rows):
    return sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)


def test_smart_dedup_matches_oracle_small(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    for name in ("smart_dedup", "smart_dedup_faithful", "dedup_funnel", "similar_titles", "similar_contents"):
        rel = con.sql(E.oracle_sql()[name])
        df = E.queries()[name](spark, SF)
        assert sorted(df.columns) == sorted(rel.columns)
        assert _values(tuple(r[c] for c in rel.columns) for r in df.collect()) == _values(rel.fetchall())
