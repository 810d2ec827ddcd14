"""Operators that SQL has no form for, against plain loops; registries and faults."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.functions import agents, extensions, metrics, weights
from parley.functions.messages import MESSAGES
from parley.operators import algebra, encode, inference, packing, relations, resample, rows
from parley.sources import readers
from parley.sources.spec import Spec
from parley.streaming import datasets as streams


def bins(items, capacity):
    """Best fit, longest first, in the order in which bins are opened."""
    out = []
    for key, n in sorted(items, key=lambda x: (-x[1], x[0])):
        fits = [b for b in out if sum(x[1] for x in b) + n <= capacity]
        best = max(fits, key=lambda b: (sum(x[1] for x in b), -out.index(b)), default=None)
        if best is None:
            out.append([(key, n)])
        else:
            best.append((key, n))
    return out


@pytest.mark.parametrize(("workers", "rows_"), [(1, 95), (3, 95), (9, 40), (2, 0)])
def test_windowed_fit(spark, workers, rows_):
    """Windows of ten rows with the last bin carried over, in contiguous shards."""
    rng = random.Random(rows_)
    items = [(i, rng.randrange(1, 25)) for i in range(rows_)]
    df = spark.createDataFrame(items or [(0, 1)], "id long, n long").limit(rows_)
    found = packing.windowed_fit(df, "n", "id", 20, workers, window=10).collect()
    shards = max(1, min(workers, -(-rows_ // 10)))
    want = []
    for s in range(shards):
        own, pack, held = items[int(s * rows_ / shards) : int((s + 1) * rows_ / shards)], 0, []
        for at in range(0, max(len(own), 1), 10):
            held += own[at : at + 10]
            made = bins(held, 20)
            held = made.pop() if len(own[at : at + 10]) == 10 and made else []
            for b in made:
                want += [(s, pack, k) for k, _ in b]
                pack += 1
        for b in bins(held, 20):
            want += [(s, pack, k) for k, _ in b]
            pack += 1
    assert sorted((r["shard"], r["pack_id"], r["id"]) for r in found) == sorted(want)


def test_best_fit_keeps_all(spark):
    rng = random.Random(5)
    items = [(i, rng.randrange(1, 60)) for i in range(300)]
    found = packing.best_fit(spark.createDataFrame(items, "id long, n long"), "n", "id", 50).collect()
    assert sum(r["n"] for r in found) == 300 and sum(r["total"] for r in found) == sum(n for _, n in items)
    assert all(r["total"] <= 50 or r["n"] == 1 for r in found)
    assert sorted(r["total"] for r in found) == sorted(sum(n for _, n in b) for b in bins(items, 50))


def test_drawn(spark):
    """Shares of a long draw, and every row of every source where all are to be exhausted."""
    df = spark.range(3000).selectExpr("id", "concat('s', id % 3) as s")
    first = algebra.drawn(df, "s", "id", {"s0": 0.6, "s1": 0.3, "s2": 0.1})
    n = Counter(r["s"] for r in first.collect())
    assert n["s0"] == 1000 and abs(n["s1"] / n["s0"] - 0.5) < 0.1
    every = algebra.drawn(df.where("id < 60"), "s", "id", {"s0": 0.6, "s1": 0.3, "s2": 0.1}, stop="all_exhausted").collect()
    assert {r["id"] for r in every} == set(range(60)) and sorted(r["slot"] for r in every) == list(range(len(every)))
    assert algebra.drawn(df, "s", "id", {"none": 1.0}).count() == 0


def test_numbered_by_hot_group(spark):
    df = spark.range(500).selectExpr("id", "if(id < 450, 'hot', 'cold') as g")
    found = {(r["g"], r["id"]): r["__rn"] for r in algebra.numbered_by(df, "g", "id").collect()}
    assert all(found[("hot", i)] == i for i in range(450)) and all(found[("cold", i)] == i - 450 for i in range(450, 500))


def test_replaced_within(spark):
    df = spark.range(40)
    with pytest.raises(ValueError, match="no replacement"):
        resample.replaced_within(df, F.col("id") < 40, "id", tries=3).collect()
    out = resample.replaced_within(df, F.col("id") % 5 == 0, "id").collect()
    assert len(out) == 40 and all(r["id"] % 5 for r in out) and {r["slot"] for r in out} == set(range(40))


def test_checked(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id long, x string")
    good, bad = rows.checked(df, {"x is there": F.col("x").isNotNull(), "x is a": F.col("x") == "a"})
    assert [r["id"] for r in good.collect()] == [1] and {r["id"]: r["error"] for r in bad.collect()} == {2: "x is there", 3: "x is a"}
    with pytest.raises(Exception, match="bad row: x is there"):
        rows.checked(df, {"x is there": F.col("x").isNotNull()}, strict=True)[0].collect()


def test_literals(spark):
    texts = ["[{'role': 'user', 'content': None}]", '[{"role": "user"}\n{"role": "tool"}]', "[{'a': True}]", "no list", None, "[{'role': \"it's\"}]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r["m"] for r in df.select(rows.repaired_messages(F.col("t")).alias("m")).collect()]
    assert [m and [x["role"] for x in m] for m in out] == [["user"], ["user", "tool"], [None], None, None, None]


def test_registries(spark, tmp_path):
    with pytest.raises(ValueError, match="exists"):
        extensions.register("reward", "format")(lambda c: c)
    with pytest.raises(ValueError, match="no loss"):
        extensions.find("loss", "none")
    (tmp_path / "own.py").write_text("from parley.functions import extensions\n\n@extensions.register('metric', 'own', exist_ok=True)\ndef own(c):\n    return c\n")
    assert extensions.load_plugins([str(tmp_path / "own.py")]) == ["plugin_own"] and extensions.find("metric", "own")(3) == 3
    with pytest.raises(ValueError):
        agents.register("hermes", agents.AGENTS["react"])

    class Parts:
        def eval(self, text: str):
            for i, x in enumerate(text.split("-")):
                yield i, x

    extensions.register_table_function(spark, "parts_of", Parts, "i int, x string")
    assert [tuple(r) for r in spark.sql("select * from parts_of('a-b')").collect()] == [(0, "a"), (1, "b")]
    short = extensions.python_reward(lambda texts: [1.0], "t")
    with pytest.raises(Exception, match="1 rewards for 2"):
        spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1).select(short).collect()


def test_specs_of_weights():
    assert weights.parsed_spec("last_round") == ("last_round", ["base"]) and weights.parsed_spec("hermes+ignore_empty_think") == ("default", ["hermes", "ignore_empty_think"])
    with pytest.raises(ValueError):
        weights.parsed_spec("all+unknown")


def test_thinking_weights(spark):
    texts = {"<think>\n\n</think>\n\nyes": [("<think>\n\n</think>\n\n", 0.0), ("yes", 1.0)], "</think> go": [("</think> ", 0.0), ("go", 1.0)], "a <think></think>": [("a <think></think>", 1.0)], "": []}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", weights.configured(F.col("t"), "ignore_empty_think").alias("s")).collect():
        assert [(s["content"], s["weight"]) for s in r["s"]] == texts[r["t"]]


def test_rounds_without_system(spark):
    row = spark.sql(f"select cast(array(struct('user', 'q', null, null), struct('assistant', 'a<|im_end|>', null, null)) as {MESSAGES}) as m, cast(array(struct('user', '{{{{SYSTEM}}}}', null, null)) as {MESSAGES}) as p")
    t = encode.ROUNDS["chatml"]
    out = row.select(encode.by_rounds(F.col("m"), t), encode.by_rounds(F.col("p"), t)).first()
    assert out[0].endswith("assistant\na<|im_end|>") and out[1] == "<|im_start|>user\n{{SYSTEM}}<|im_end|>\n<|im_start|>assistant\n"


def test_answered_faults(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string").coalesce(1)
    with pytest.raises(Exception, match="1 answers for 2"):
        inference.answered(df, "t", lambda texts: texts[:1]).collect()


def test_range_join_edges(spark):
    points = spark.createDataFrame([(0, 0.0), (1, 9.99), (2, 10.0), (3, None), (4, -5.0)], "id int, x double")
    ranges = spark.createDataFrame([("a", 0.0, 10.0), ("b", 10.0, 10.0), ("c", -7.5, 3.0), ("d", None, 5.0)], "r string, lo double, hi double")
    out = relations.range_join(points, ranges, "x", "lo", "hi", 4).select("id", "r").collect()
    assert sorted(map(tuple, out)) == [(0, "a"), (0, "c"), (1, "a"), (4, "c")]
    with pytest.raises(Exception, match="no partner"):
        relations.zipped(points.select("id"), points.where("id < 3").select("id", "x"), "id").collect()


def test_paths_with_schemes():
    assert Spec.parse("s3a://bucket/x.jsonl:part#9", lambda p: False) == Spec("s3a://bucket/x.jsonl", ("part",), 9)


def test_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (5, 3):
        readers.write_batch(spark.range(n), path, 7)
    readers.write_batch(spark.range(2), path, 8)
    assert spark.read.parquet(path).count() == 5 and readers.written_batches(spark, path) == [7, 8]
    with pytest.raises(ValueError):
        streams.split(spark.range(1), 0.5)


def test_common_length():
    rng = random.Random(9)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        assert metrics.common_length(a, b) == row[-1]
    assert metrics.words_of("ab 中文字 c中") == ["ab", "中", "文", "字", "c", "中"]
    assert metrics.overlap(list("abcde"), list("abcde"))[:3] == (1.0, 1.0, 1.0) and metrics.overlap(["x"], ["y"]) == (0.0, 0.0, 0.0, 0.0)


def test_approx_quantiles_are_near(spark, data):
    """Approximate quantiles lie within a hundredth of their ranks, and distinct counts within a tenth."""
    from parley.plans.registry import QUERIES

    rows = spark.read.parquet(f"{data}/lineitem.parquet").select("l_returnflag", "l_extendedprice", "l_orderkey").collect()
    for r in QUERIES["rel_approx_quantiles"](spark, data).collect():
        own = [x for x in rows if x["l_returnflag"] == r["l_returnflag"]]
        for q, v in zip((0.5, 0.9), r["price"], strict=True):
            assert abs(sum(x["l_extendedprice"] <= v for x in own) / len(own) - q) < 0.01
        assert abs(r["orders"] / len({x["l_orderkey"] for x in own}) - 1) < 0.1
