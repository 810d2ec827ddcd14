"""Packing and negatives beyond one shard or pool, against sequential versions."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from parley.operators import packing


def sequential(lengths, capacity):
    pack, used, out = -1, capacity, []
    for n in lengths:
        if used >= capacity or used + n > capacity:
            pack, used = pack + 1, 0
        used += n
        out.append(pack)
    return out


@pytest.mark.parametrize(("shard", "longest"), [(7, 30), (3, 3), (50, 9)])
def test_packs_over_shards(spark, shard, longest):
    """The open pack goes over shard borders, and over whole shards."""
    rng = random.Random(shard)
    lengths = [rng.randrange(longest + 1) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(lengths)), "id long, n long")
    found = {r["id"]: r["pack_id"] for r in packing.next_fit(df, "n", "id", 16, shard_rows=shard).collect()}
    assert [found[i] for i in range(300)] == sequential(lengths, 16)


def test_pool_of_any_size(spark, monkeypatch):
    """A pool beyond POOL_ROWS gives the items that one ranking of all pairs gives."""
    monkeypatch.setattr(packing, "POOL_ROWS", 10)
    pool = spark.range(57).withColumnRenamed("id", "item")
    out = packing.negatives(spark.range(9), pool, "id", "item", lambda d, b: F.col(b) % 10 != F.col(d) % 10, 3).collect()
    order = lambda d: sorted((b for b in range(57) if b % 10 != d % 10), key=lambda b: hashlib.md5(f"{d}:{b}".encode()).hexdigest())
    assert sorted((r["id"], r["rank"], r["item"]) for r in out) == [(d, k + 1, order(d)[k]) for d in range(9) for k in range(3)]
