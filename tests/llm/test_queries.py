"""Queries with SQL against it, and the pipeline against its stages."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from parley.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, data, name):
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    wanted = sorted((tuple(dict(zip(names, row, strict=True))[c] for c in columns) for row in result.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == wanted


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append(docs.count())
    assert 0.9 * seen[0] <= seen[1] <= seen[0] and seen[2] == seen[1] and 0 < seen[3] < seen[2]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert sorted(map(str, corpus_pipeline.run(spark, data).collect())) == sorted(map(str, last.collect()))
