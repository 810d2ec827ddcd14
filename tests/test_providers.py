"""Providers' formats, on conversations made here."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from parley.functions import providers
from parley.functions.toolcalls import PARSERS


def read(spark, *conversations, form="auto"):
    texts = [c if isinstance(c, str) or c is None else json.dumps(c) for c in conversations]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, j string")
    return [r["n"] for r in df.select("i", providers.normalized(providers.F.col("j"), form).alias("n")).orderBy("i").collect()]


def flat(row):
    return [(m["role"], json.loads(m["content"]) if m["role"] == "tool_call" else m["content"]) for m in row["messages"]]


def test_calls_beside_text(spark):
    weather = {"id": "1", "type": "function", "function": {"name": "weather", "arguments": '{"city": "Graz", "days": [1, 2]}'}}
    bare = {"name": "clock", "arguments": "now, please"}
    empty = {"function": {"name": "noop"}}
    said = {"role": "assistant", "content": "let me look", "tool_calls": [weather, bare, empty], "loss": True, "loss_scale": 0.5}
    (one,) = read(spark, [{"role": "user", "content": "?"}, said, {"role": "tool", "content": "sun"}, {"role": "user", "content": "!", "tool_calls": [bare]}])
    assert flat(one) == [
        ("user", "?"),
        ("assistant", "let me look"),
        ("tool_call", {"name": "weather", "arguments": {"city": "Graz", "days": [1, 2]}}),
        ("tool_call", {"name": "clock", "arguments": "now, please"}),
        ("tool_call", {"name": "noop", "arguments": {}}),
        ("tool", "sun"),
        ("user", "!"),
    ]
    assert [(m["loss"], m["loss_scale"]) for m in one["messages"][1:5]] == [(True, 0.5)] * 4 and one["messages"][0]["loss"] is None
    assert one["format"] == "openai" and one["error"] is None


def test_calls_without_text(spark):
    for content in (None, ""):
        (one,) = read(spark, [{"role": "assistant", "content": content, "tool_calls": [{"function": {"name": "f", "arguments": {"a": 1}}}]}])
        assert flat(one) == [("tool_call", {"name": "f", "arguments": {"a": 1}})]


def test_blocks_between_calls(spark):
    use = lambda name: {"type": "tool_use", "id": name, "name": name, "input": {"q": name}}
    blocks = [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}, use("x"), use("y"), {"type": "text", "text": "c"}, use("z")]
    results = [
        {"type": "tool_result", "tool_use_id": "x", "content": [{"type": "text", "text": "seen "}, {"type": "image", "source": {"type": "base64", "media_type": "image/png", "data": "QUJD"}}]},
        {"type": "tool_result", "tool_use_id": "y"},
        {"type": "text", "text": "and so?"},
    ]
    (one,) = read(spark, [{"role": "assistant", "content": blocks}, {"role": "user", "content": results}])
    assert flat(one) == [
        ("assistant", "ab"), ("tool_call", {"name": "x", "arguments": {"q": "x"}}), ("tool_call", {"name": "y", "arguments": {"q": "y"}}), ("assistant", "c"),
        ("tool_call", {"name": "z", "arguments": {"q": "z"}}), ("tool_response", "seen <image>"), ("tool_response", ""), ("user", "and so?"),
    ]
    assert one["images"] == ["data:image/png;base64,QUJD"] and one["format"] == "anthropic"


def test_media_by_kind(spark):
    blocks = [
        {"type": "image_url", "image_url": {"url": "i1"}}, {"type": "text", "text": " hears "}, {"type": "audio_url", "audio_url": "a1"},
        {"type": "video_url", "video_url": {"url": "v1"}}, {"type": "image_url", "image_url": "i2"},
    ]
    (one,) = read(spark, [{"role": "user", "content": blocks}])
    assert flat(one) == [("user", "<image> hears <audio><video><image>")]
    assert (one["images"], one["audios"], one["videos"]) == (["i1", "i2"], ["a1"], ["v1"])


def test_errors_are_told(spark):
    odd = [{"role": "user", "content": [{"type": "hologram"}]}]
    rows = read(spark, None, "no json", "{}", odd, [{"content": "x"}], [{"role": "user", "content": "[1, 2]"}])
    assert [r["messages"] is None for r in rows] == [True] * 5 + [False]
    assert rows[3]["error"] == "unknown block hologram" and all(r["error"] for r in rows[:5]) and rows[5]["messages"][0]["content"] == "[1, 2]"


def test_forced_format(spark):
    plain = [{"role": "user", "content": "hi"}]
    assert [read(spark, plain, form=f)[0]["format"] for f in ("auto", "openai", "anthropic")] == ["native", "openai", "anthropic"]


def test_action_reward(spark):
    call = lambda name, given: f"Thought: t\nAction: {name}\nAction Input: {given}\nObservation: o"
    rows = [
        (call("f", '{"a": 1, "b": [2]}'), call("f", '{"b": [2], "a": 1}'), 1.0),
        (call("f", "{}"), call("f", "{}"), 1.0),
        (call("f", '{"a": 1}'), call("g", '{"a": 1}'), 0.0),
        (call("f", '{"a": 1}'), call("f", '{"a": 2}'), 0.0),
        (call("f", "word"), call("f", "word"), 0.0),
        (call("f", '{"a": 1}'), call("f", "word"), 0.0),
        ("nothing", call("f", "{}"), 0.0),
        (None, None, 0.0),
    ]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    assert all(r["r"] == r["want"] for r in df.select(providers.action_reward(providers.F.col("a"), providers.F.col("b")).alias("r"), "want").collect())


def test_parsers(spark):
    texts = {
        "deepseek": "<｜tool▁call▁begin｜>f<｜tool▁sep｜>{\"a\":\"1\"}<｜tool▁call▁end｜>",
        "kimi": '<|tool_call_begin|>f<|tool_call_argument_begin|>{"a":"1"}<|tool_call_end|>',
        "qwen": '✿FUNCTION✿: f\n✿ARGS✿: {"a":"1"}\n✿RESULT✿',
        "mistral": '[TOOL_CALLS] [{"name": "f", "arguments": {"a":"1"}}]',
        "qwen_coder": "<tool_call><function=f><parameter=a>\n1\n</parameter></function></tool_call>",
        "glm": "<tool_call>f\n<arg_key>a</arg_key><arg_value>1</arg_value></tool_call>",
        "hermes": '<tool_call>{"name": "f", "arguments": {"a":"1"}}</tool_call>',
        "llama": '{"name": "f", "parameters": {"a":"1"}}',
        "react": 'Action: f\nAction Input: {"a":"1"}',
    }
    row = spark.range(1).select(*[PARSERS[n](F.lit(t)).alias(n) for n, t in texts.items()], *[PARSERS[n](F.lit("no call")).alias(n + "0") for n in texts]).first()
    for n in texts:
        assert [(c["name"], json.loads(c["arguments"])) for c in row[n]] == [("f", {"a": "1"})], n
        assert row[n + "0"] == [], n
