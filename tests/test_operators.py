"""Invariants and hand-made cases of operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.functions import metrics, rewards, weights
from parley.operators import algebra, packing
from parley.streaming import packing as stream_packing
from parley.streaming import windows


def test_next_fit_by_hand(spark):
    df = spark.createDataFrame(list(enumerate([5, 9, 3, 20, 1, 15])), "id long, n long")
    found = {r["id"]: r["pack_id"] for r in packing.next_fit(df, "n", "id", 16).collect()}
    assert [found[i] for i in range(6)] == [0, 0, 1, 2, 3, 3]


def test_packs_hold_all_rows(spark):
    df = spark.range(40).select("id", (F.col("id") % 10 + 1).alias("n"))
    packs = packing.best_fit(df, "n", "id", 16).collect()
    assert sum(p["n"] for p in packs) == 40 and all(p["total"] <= 16 for p in packs)
    shards = packing.next_fit(df, "n", "id", 16, shard_rows=7)
    assert shards.count() == 40 and shards.groupBy("pack_id").agg(F.sum("n").alias("t")).where("t > 16").count() == 0


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert [r["rn"] for r in algebra.numbered(df, ["k"]).orderBy("k").collect()] == list(range(1000))


@pytest.mark.parametrize("n", [None, 0, 3, 10, 27])
def test_sample(spark, n):
    out = algebra.sample(spark.range(10), n, "id")
    assert out.count() == (10 if n is None else n)


def test_split_is_exact(spark):
    parts = {r["part"]: r["count"] for r in algebra.split(spark.range(101), 0.1, "id").groupBy("part").count().collect()}
    assert parts == {"val": 10, "train": 91}


def test_interleave_all(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "s string, k long")
    out = algebra.interleave(df, "s", "k", ["a", "b"], "all_exhausted").orderBy("slot").collect()
    assert [r["k"] for r in out] == [1, 4, 2, 4, 3, 4]
    assert [r["k"] for r in algebra.interleave(df, "s", "k", ["a", "b"]).orderBy("slot").collect()] == [1, 4, 2]


def test_segments_join_again(spark):
    df = spark.createDataFrame([("ab<x>cd<y><x>",), ("",), ("plain",)], "t string")
    for r in df.select("t", weights.split_by(F.col("t"), ["<x>", "<y>"]).alias("p")).collect():
        assert "".join(x["key"] + x["content"] for x in r["p"]) == r["t"]


def test_overlap():
    assert metrics.overlap("a b c d".split(), "a b c d".split()) == (1, 1, 1, 1)
    assert metrics.overlap("x y".split(), "a b".split())[3] == 0.0


def test_boxed(spark):
    row = spark.range(1).select(rewards.boxed_answer(F.lit(r"x \boxed{1} then \boxed{ 4 2 }")).alias("a"), rewards.boxed_answer(F.lit("none")).alias("b")).first()
    assert row["a"] == "42" and row["b"] is None


def test_streaming_counts_equal_batch(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = windows.read(spark, str(tmp_path / "in"), events.schema)
    q = windows.counts(stream, "1 hour", None, ["event_type"]).writeStream.format("memory").queryName("w").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = windows.counts(events, "1 hour", None, ["event_type"])
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, batch.collect()))


def test_streaming_packs(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 10 + 1).alias("n")).repartition(2).write.parquet(str(tmp_path / "in"))
    stream = windows.read(spark, str(tmp_path / "in"), "id long, n long")
    q = stream_packing.pack(stream, "n", "id", 16, lanes=2).writeStream.format("memory").queryName("p").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    packs = spark.table("p").collect()
    assert packs and all(p["total"] <= 16 for p in packs) and sum(p["n"] for p in packs) <= 100
