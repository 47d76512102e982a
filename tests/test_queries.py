"""Every query with SQL gives the rows that DuckDB gives for it."""

import os

import duckdb
import pytest

from millrace.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


def cell(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or str(v) in ("<NA>", "NaT", "nan"):
        return None
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, (int, bool)) else str(v)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted([tuple(map(cell, r)) for r in frame.itertuples(index=False)], key=repr)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in os.listdir(FOLDER):
        con.execute(f"create view {name[:-8]} as select * from '{FOLDER}/{name}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, con, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(p == q or (isinstance(p, float) and isinstance(q, (int, float)) and abs(p - q) <= 1e-3) for p, q in zip(x, y, strict=True)), (x, y)
