"""Every registered query of the engine against its SQL, on the smallest tables."""

from __future__ import annotations

import decimal
import glob
import os

import duckdb
import pytest

from parley.plans.registry import QUERIES, SQL


def plain(x):
    if isinstance(x, (float, decimal.Decimal)):
        return round(float(x), 8)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


@pytest.fixture(scope="module")
def tables(data):
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, tables, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in SQL:
        assert found
        return
    result = tables.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(plain(dict(zip(names, row, strict=True))[c]) for c in columns) for row in result.fetchall()), key=repr)
    assert found == wanted
