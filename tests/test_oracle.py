"""Every registered query against its SQL oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from shoal.sources.testdata import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else str(v))
                         for v in r))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    order = [ocols.index(c) for c in cols]
    want = _norm([tuple(r[i] for i in order) for r in res.fetchall()])
    assert _norm(df.collect()) == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "reason" in df.columns
