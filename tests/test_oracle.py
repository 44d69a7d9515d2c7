"""Every query with SQL gives the rows DuckDB gives; every other one runs."""

from __future__ import annotations

import datetime
import glob
import math
import os

import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
CORE = sorted(n for n in QUERIES if not n.startswith("p") or not n[1:2].isdigit())


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(sf + "/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", CORE)
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    rows = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in ORACLE:
        assert cols
        return
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted((tuple(norm(r[i]) for i in at) for r in cur.fetchall()), key=repr)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "windows", "tokens"] and df.count() > 0
