"""The driver's gate in small: every registered query against its DuckDB SQL."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") if not math.isnan(v) else "nan"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def test_every_query_has_sql_or_is_marked():
    from podium.plans.queries import ORACLE_SQL, QUERIES
    assert set(QUERIES) - set(ORACLE_SQL) == {"file_manifest", "ml_score"}
    for qs, sql in ((QUERIES, ORACLE_SQL), (E.queries(), E.oracle_sql())):
        assert set(sql) <= set(qs)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["priority", "qualified", "qualification_type", "n"]
