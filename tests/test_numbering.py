"""Row numbers of tables whose range partitions AQE puts together by their bytes, against plain loops."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from parley.operators import algebra, packing, resample

N = 3000
SETTINGS = {f"spark.sql.adaptive.{k}": v for k, v in {"coalescePartitions.parallelismFirst": "false", "coalescePartitions.minPartitionSize": "1k", "advisoryPartitionSizeInBytes": "256k"}.items()}


@pytest.fixture
def wide(spark):
    """Ids alone would fill one partition, with the texts they fill several."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    text = F.concat_ws(":", *[F.sha2((F.col("id") + i).cast("string").cast("binary"), 512) for i in range(8)])
    yield spark.range(N).select(F.col("id"), (F.col("id") * 7919 % 1009).alias("n"), text.alias("text"))
    for key in SETTINGS:
        spark.conf.unset(key)


def hashed(i: int) -> tuple:
    return hashlib.md5(f"{i}:42".encode()).hexdigest(), i


def test_replaced_within_wide_rows(wide):
    order, failed = sorted(range(N), key=hashed), [i for i in range(N) if i % 4 == 0]
    wanted = {i: i for i in range(N) if i % 4}
    for at, i in enumerate(failed):
        wanted[i] = next(order[k] for k in ((at * 10 + t) % N for t in range(10)) if order[k] % 4)
    out = resample.replaced_within(wide, F.col("id") % 4 == 0, "id").collect()
    assert len(out) == N and {r["slot"]: r["id"] for r in out} == wanted


def test_length_batches_wide_rows(wide):
    order, wanted = sorted(range(N), key=hashed), {}
    for mega in range(0, N, 64):
        for k, i in enumerate(sorted(order[mega : mega + 64], key=lambda i: (-(i * 7919 % 1009), i))):
            wanted[i] = mega // 8 + k // 8
    out = algebra.length_batches(wide, "n", "id", 8, 8).collect()
    assert len(out) == N and {r["id"]: r["batch"] for r in out} == wanted


def test_length_batches_null_key(spark):
    ids = [None, *range(130)]
    order = sorted(ids, key=lambda i: (i is None, i is not None and hashed(i)))
    wanted = {i: m // 8 + k // 8 for m in range(0, 131, 64) for k, i in enumerate(sorted(order[m : m + 64], key=lambda i: (i is None, i or 0)))}
    df = spark.createDataFrame([(i, 5) for i in ids], "id long, n long")
    assert {r["id"]: r["batch"] for r in algebra.length_batches(df, "n", "id", 8, 8).collect()} == wanted


def test_rotate_in_batches_wide_rows(wide):
    texts = {r["id"]: r["text"] for r in wide.collect()}
    out = packing.rotate_in_batches(wide, "text", "id", 8, "before").select("id", "before").collect()
    assert len(out) == N and all(r["before"] == texts[r["id"] - 1 if r["id"] % 8 else r["id"] + 7] for r in out)


def test_rotate_in_batches_null_key(spark):
    ids = [*range(20), None]
    wanted = {i: str(ids[at - 1 if at % 8 else min(at + 7, 20)]) for at, i in enumerate(ids)}
    df = spark.createDataFrame([(i, str(i)) for i in reversed(ids)], "id long, text string")
    assert {r["id"]: r["before"] for r in packing.rotate_in_batches(df, "text", "id", 8, "before").collect()} == wanted
