"""Registered queries agree with their DuckDB oracles on the smallest tables."""

import math

import duckdb
import pytest

from conftest import SMALL

from fieldloom.plans.queries import QUERIES  # noqa: E402

def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    from fieldloom.plans.tables import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want
