"""Sums whose last bits decide, added in the order in which rows are stored."""

from __future__ import annotations

import random

import duckdb

from parley.plans.registry import QUERIES, SQL


def test_sequence_mask_at_the_border(spark, tmp_path):
    """Sequences over several files whose means are 0.1 in decimals; DuckDB with one thread adds as stored."""
    rng = random.Random(5)
    rows = []
    for seq in range(3000):
        gaps = [rng.randrange(-6, 10) for _ in range(6)]
        gaps.append(7 - sum(gaps))
        for i, gap in enumerate(gaps):
            tax = rng.randrange(0, 9)
            rows.append((seq, i + 1, 3.0, (tax + gap) / 100, tax / 100))
    rng.shuffle(rows)
    at = tmp_path / "lineitem.parquet"
    for i in range(4):
        part = spark.createDataFrame(rows[i::4], "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double")
        part.coalesce(1).write.parquet(f"{tmp_path}/made{i}")
        at.mkdir(exist_ok=True)
        next((tmp_path / f"made{i}").glob("*.parquet")).rename(at / f"{i}.parquet")
    con = duckdb.connect()
    con.execute("set threads = 1")
    con.execute(f"create view lineitem as select * from '{at}/*.parquet'")
    wanted = sorted(con.execute(SQL["v12f_sequence_mask"]).fetchall())
    assert 0 < len(wanted) < 3000
    assert sorted(map(tuple, QUERIES["v12f_sequence_mask"](spark, str(tmp_path)).collect())) == wanted
