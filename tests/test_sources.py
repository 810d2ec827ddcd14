"""Specifications, the registry, readers and normalization."""

from __future__ import annotations

import json

import pytest

from parley.operators import normalize
from parley.sources.readers import load_dataset, read_cached, read_file, write_cached
from parley.sources.spec import Dataset, Registry, Spec, Subset


def test_spec():
    never = lambda p: False
    assert Spec.parse("hf::org/data:a/ b#500", never) == Spec("org/data", ("a", "b"), 500, "hf")
    assert Spec.parse("data", never) == Spec("data")
    assert Spec.parse("odd:name#5", lambda p: True) == Spec("odd:name#5")


def test_registry(tmp_path):
    r = Registry()
    r.register("x", Dataset("/data/x", subsets=[Subset("a"), Subset("b", is_weak=True), Subset("default")]))
    with pytest.raises(ValueError):
        r.register("x", Dataset())
    d = r.resolve(Spec("other/x"))
    assert [s.name for s in d.select(())] == ["default"]
    assert [s.name for s in d.select(("all",))] == ["a", "default"]
    assert d.select(("new",))[0].subset == "new"
    path = tmp_path / "info.json"
    path.write_text(json.dumps([{"dataset_path": "rel.jsonl", "columns": {"Q": "query"}}]))
    (name,) = r.register_json(str(path))
    assert r.datasets[name].path == str(tmp_path / "rel.jsonl")


def conv(df):
    return [[(m["role"], m["content"]) for m in r["messages"]] for r in df.collect()]


def write(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return str(path)


def test_alpaca(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", [{"instruction": "do", "input": "it", "output": "done", "system": "s"}, {"instruction": "do", "input": "", "output": "ok", "system": None}])
    assert conv(load_dataset(spark, p)) == [[("system", "s"), ("user", "do\nit"), ("assistant", "done")], [("user", "do"), ("assistant", "ok")]]


def test_csv_keeps_strings(spark, tmp_path):
    (tmp_path / "a.csv").write_text("system,instruction,input,output\n00000,11111,,3\n,q,,a\n")
    df = read_file(spark, str(tmp_path / "a.csv"))
    assert df.first()["system"] == "00000"
    assert conv(load_dataset(spark, str(tmp_path / "a.csv")))[1] == [("system", ""), ("user", "q"), ("assistant", "a")]


def test_history(spark, tmp_path):
    p = write(tmp_path / "h.jsonl", [{"query": "q2", "response": "a2", "history": [["q1", "a1"]]}, {"query": "q", "response": "a", "history": None}])
    assert conv(load_dataset(spark, p)) == [[("user", "q1"), ("assistant", "a1"), ("user", "q2"), ("assistant", "a2")], [("user", "q"), ("assistant", "a")]]


def test_messages_layouts(spark, tmp_path):
    p = write(tmp_path / "c.jsonl", [{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "s"}])
    assert conv(load_dataset(spark, p)) == [[("system", "s"), ("user", "q"), ("assistant", "a")]]
    p = write(tmp_path / "d.jsonl", [{"conversation": [{"human": "q", "assistant": "a"}, {"human": "q", "assistant": "b"}]}])
    assert conv(load_dataset(spark, p)) == [[("user", "q"), ("assistant", "a"), ("user", "q"), ("assistant", "b")]]


def test_bad_rows(spark, tmp_path):
    rows = [{"messages": [{"role": "user", "content": "q"}]}, {"messages": []}, {"messages": [{"role": "odd", "content": "x"}]}]
    p = write(tmp_path / "b.jsonl", rows)
    assert len(conv(load_dataset(spark, p))) == 1
    with pytest.raises(Exception, match="no valid conversation"):
        normalize.valid_rows(normalize.messages_preprocess(read_file(spark, p)).union(spark.createDataFrame([([],)], f"messages {normalize.M.MESSAGES}")), strict=True).collect()


def test_sample_and_tag(spark, tmp_path):
    p = write(tmp_path / "s.jsonl", [{"query": str(i), "response": "a"} for i in range(10)])
    df = load_dataset(spark, [f"{p}#25", p], tag=True)
    assert df.count() == 35 and df.select("dataset").distinct().count() == 2


def test_rename_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, B int, C int")
    assert normalize.rename_columns(df, {"a": "x", "b": "x", "c": "y"}).columns == ["A", "B", "y"]


def test_cached(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, 9)], "id int, n int")
    write_cached(df, str(tmp_path / "c"), normalize.F.array("n"))
    assert [r["id"] for r in read_cached(spark, str(tmp_path / "c"), 6).collect()] == [1]


def test_openai_calls(spark):
    df = spark.sql("""select 'hi' content, array(named_struct('function', named_struct('name', 'f', 'arguments', '{"a":1}')), named_struct('function', named_struct('name', 'g', 'arguments', 'oops'))) calls""")
    m = df.select(normalize.openai_calls(normalize.F.col("content"), normalize.F.col("calls")).alias("m")).first()["m"]
    assert [x["role"] for x in m] == ["assistant", "tool_call", "tool_call"]
    assert json.loads(m[1]["content"]) == {"name": "f", "arguments": {"a": 1}}


def test_boxes_and_images(spark):
    F = normalize.F
    row = spark.range(1).select(
        normalize.checked_boxes(F.array(F.array(F.lit(3.0), F.lit(4.0), F.lit(1.0), F.lit(2.0)))).alias("b"), *[c.alias(n) for c, n in zip(normalize.image_tags(F.lit("a <img>x.png</img> b")), ("t", "p"), strict=True)]
    ).first()
    assert row["b"] == [[1.0, 2.0, 3.0, 4.0]] and row["t"] == "a <image> b" and row["p"] == ["x.png"]
