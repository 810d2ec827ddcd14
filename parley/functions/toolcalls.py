"""Tool calls in assistants' texts, read back as arrays of (name, arguments)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CALL = "struct<name string, arguments string>"


def hermes_calls(text: Column) -> Column:
    """JSON objects with a name and arguments between '<tool_call>' and '</tool_call>'; without any, ReAct calls."""
    bodies = F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>(.+?)</tool_call>"), F.lit(1))
    calls = F.transform(bodies, lambda b: F.struct(F.get_json_object(b, "$.name").alias("name"), F.get_json_object(b, "$.arguments").alias("arguments")))
    calls = F.filter(calls, lambda c: c["name"].isNotNull() & c["arguments"].isNotNull())
    return F.when(F.size(calls) > 0, calls).otherwise(react_calls(text))


def react_calls(text: Column) -> Column:
    """'Action: name' followed by 'Action Input: arguments', up to an observation or another action."""
    pattern = r"(?s)Action:\s*([^\n]*?)\s*\n?\s*Action Input:\s*(.*?)\s*(?=Observation:|Action:|\z)"
    names = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    inputs = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    return F.transform(F.arrays_zip(names.alias("name"), inputs.alias("arguments")), lambda c: F.struct(c["name"].alias("name"), c["arguments"].alias("arguments")))


def llama_calls(text: Column) -> Column:
    """JSON objects with a name and flat parameters; without any, ReAct calls."""
    bodies = F.regexp_extract_all(text, F.lit(r'(?s)(\{[^{]*?"name":.*?"parameters":\s*\{.*?\}\s*\})'), F.lit(1))
    calls = F.transform(bodies, lambda b: F.struct(F.get_json_object(b, "$.name").alias("name"), F.get_json_object(b, "$.parameters").alias("arguments")))
    calls = F.filter(calls, lambda c: c["name"].isNotNull())
    return F.when(F.size(calls) > 0, calls).otherwise(react_calls(text))


def glm_calls(text: Column) -> Column:
    """'<tool_call>name<arg_key>k</arg_key><arg_value>v</arg_value>...</tool_call>'; the arguments become a JSON object of strings."""
    bodies = F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>(.*?)</tool_call>"), F.lit(1))

    def call(body: Column) -> Column:
        keys = F.regexp_extract_all(body, F.lit(r"(?s)<arg_key>(.*?)</arg_key>"), F.lit(1))
        values = F.regexp_extract_all(body, F.lit(r"(?s)<arg_value>(.*?)</arg_value>"), F.lit(1))
        return F.struct(F.regexp_replace(F.substring_index(body, "<arg_key>", 1), r"^\s+|\s+$", "").alias("name"), F.to_json(F.map_from_arrays(keys, F.slice(values, F.lit(1), F.size(keys)))).alias("arguments"))

    return F.transform(bodies, call)


#: Readers by the name of the format.
PARSERS = {"hermes": hermes_calls, "react": react_calls, "llama": llama_calls, "glm": glm_calls}


def tagged_calls(text: Column, start: str, middle: str, end: str) -> Column:
    """Calls written as start, name, middle, arguments, end; the marks are literal."""
    import re

    pattern = f"(?s){re.escape(start)}\\s*(.*?)\\s*{re.escape(middle)}\\s*(.*?)\\s*{re.escape(end)}"
    names = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    arguments = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    return F.transform(F.arrays_zip(names.alias("n"), arguments.alias("a")), lambda c: F.struct(c["n"].alias("name"), c["a"].alias("arguments")))


def listed_calls(text: Column, mark: str) -> Column:
    """Calls written as a list of JSON objects with name and arguments after a mark, with commas or line feeds between them; without any, ReAct calls."""
    body = F.regexp_extract(F.substring_index(text, mark, -1), r"(?s)(\[.*\])", 1)
    made = F.from_json(F.regexp_replace(body, r"\}\s*\n\s*\{", "},{"), "array<struct<name string, arguments string>>")
    made = F.filter(made, lambda c: c["name"].isNotNull() & c["arguments"].isNotNull())
    return F.when(F.contains(text, F.lit(mark)) & (F.size(made) > 0), made).otherwise(react_calls(text))


def nested_calls(text: Column) -> Column:
    """'<function=name><parameter=key>value</parameter>...</function>'; the arguments become a JSON object of strings."""
    bodies = F.regexp_extract_all(text, F.lit(r"(?s)<function=(.*?</function>)"), F.lit(1))

    def call(body: Column) -> Column:
        keys = F.regexp_extract_all(body, F.lit(r"(?s)<parameter=([^>]*)>\s*(.*?)\s*</parameter>"), F.lit(1))
        values = F.regexp_extract_all(body, F.lit(r"(?s)<parameter=([^>]*)>\s*(.*?)\s*</parameter>"), F.lit(2))
        return F.struct(F.substring_index(body, ">", 1).alias("name"), F.to_json(F.map_from_arrays(keys, values)).alias("arguments"))

    return F.transform(bodies, call)


# The marks of calls in public models' formats.
TAGGED = {
    "deepseek": ("<｜tool▁call▁begin｜>", "<｜tool▁sep｜>", "<｜tool▁call▁end｜>"),
    "kimi": ("<|tool_call_begin|>", "<|tool_call_argument_begin|>", "<|tool_call_end|>"),
    "qwen": ("✿FUNCTION✿:", "✿ARGS✿:", "\n"),
    "hunyuan": ("<tool_call>", "\n```json", "```</tool_call>"),
}
PARSERS |= {name: (lambda text, marks=marks: tagged_calls(text, *marks)) for name, marks in TAGGED.items()}
PARSERS |= {"mistral": lambda text: listed_calls(text, "[TOOL_CALLS]"), "qwen_coder": nested_calls}


def marked_calls(text: Column, block: str, head: str, parameter: str, close: str) -> Column:
    """Calls of nested tags in blocks: ``head`` and ``parameter`` are patterns with a group for the name, ``close`` ends a parameter's value."""
    bodies = F.regexp_extract_all(text, F.lit(block), F.lit(1))
    whole = f"(?s){parameter}\\s*(.*?)\\s*{close}"

    def call(body: Column) -> Column:
        keys, values = (F.regexp_extract_all(body, F.lit(whole), F.lit(i)) for i in (1, 2))
        return F.struct(F.regexp_extract(body, head, 1).alias("name"), F.to_json(F.map_from_arrays(keys, values)).alias("arguments"))

    return F.filter(F.transform(bodies, call), lambda c: c["name"] != "")


# Patterns of formats with nested tags, as (block, head, parameter, end of a value).
NESTED = {
    "seed": (r"(?s)<seed:tool_call>(.+?)</seed:tool_call>", r"<function=([^>]+)>", r"<parameter=([^>]+)>", r"</parameter>"),
    "minimax": (r'(?s)(<invoke name="[^"]+">.*?</invoke>)', r'<invoke name="([^"]+)">', r'<parameter name="([^"]+)">', r"</parameter>"),
}
PARSERS |= {name: (lambda text, marks=marks: marked_calls(text, *marks)) for name, marks in NESTED.items()}
#: Other names of the same formats.
PARSERS |= {"hunyuan_hermes": PARSERS["hunyuan"], "youtu": hermes_calls, "llama3": llama_calls, "llama4": llama_calls, "glm4_5": glm_calls, "qwen_en": PARSERS["qwen"], "qwen3_coder": nested_calls, "qwen3_5": nested_calls, "deepseek_v3_1": PARSERS["deepseek"], "kimi_k25": PARSERS["kimi"], "react_en": react_calls, "react_zh": react_calls, "seed_oss": PARSERS["seed"], "minimax_m2": PARSERS["minimax"], "toolbench": react_calls}


def register(name: str, parser, exist_ok: bool = False) -> None:
    """Add a reader; a name that is taken raises unless it may be replaced."""
    if name in PARSERS and not exist_ok:
        raise ValueError(f"the format {name!r} exists")
    PARSERS[name] = parser
