"""Tools and tool calls written into conversations, in the formats of public agents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.bind import bound
from parley.functions.messages import MESSAGES, message

# Keywords of the ReAct format.
ACTION, ACTION_INPUT, OBSERVATION = "Action:", "Action Input:", "Observation:"


def wrapped_tool(tool: Column) -> Column:
    """A tool in JSON as ``{"type":"function","function":...}``; one that is so already stays, one that is no JSON object is null."""
    body = F.when(F.get_json_object(tool, "$.function").isNull(), F.concat(F.lit('{"type":"function","function":'), tool, F.lit("}"))).otherwise(tool)
    return F.when(F.from_json(tool, "map<string,string>").isNotNull() & F.startswith(F.trim(tool), F.lit("{")), body)


def listed_tools(tools: Column) -> Column:
    """A JSON list of tools, or one, as an array of wrapped ones; those that can't be read are left out."""
    many = F.when(F.startswith(F.trim(tools), F.lit("[")), F.from_json(tools, "array<string>")).otherwise(F.array(tools))
    return F.filter(F.transform(many, wrapped_tool), lambda t: t.isNotNull())


def tool_field(tool: Column, field: str) -> Column:
    """A field of a wrapped tool's function."""
    return F.coalesce(F.get_json_object(tool, f"$.function.{field}"), F.lit(""))


def call_parts(content: Column) -> Column:
    """Name and arguments of a call in JSON; arguments may be named parameters."""
    arguments = F.coalesce(F.get_json_object(content, "$.arguments"), F.get_json_object(content, "$.parameters"), F.lit("{}"))
    return F.struct(F.get_json_object(content, "$.name").alias("name"), arguments.alias("arguments"))


def as_object(call: Column) -> Column:
    """A call as a JSON object; arguments that are an object or a list stay what they are, others become a string."""
    open_ = F.rlike(F.ltrim(call["arguments"]), F.lit(r"^[\[{]"))
    name = F.get_json_object(F.to_json(F.struct(call["name"].alias("n"))), "$.n")
    quoted = F.substring(F.to_json(F.array(call["arguments"])), 2, 2**31 - 1)
    given = F.when(open_, call["arguments"]).otherwise(F.substring(quoted, F.lit(1), F.length(quoted) - 1))
    return F.concat(F.lit('{"name": "'), name, F.lit('", "arguments": '), given, F.lit("}"))


def joined(items: Column, each: Callable[[Column], Column], between: str = "\n") -> Column:
    return F.array_join(F.transform(items, each), between)


def between(before: str, body: Column, after: str) -> Column:
    return F.concat(F.lit(before), body, F.lit(after))


@dataclass(frozen=True)
class Agent:
    """How an agent's format writes calls (of name and arguments), results (contents), and tools (wrapped, after a system prompt)."""

    calls: Callable[[Column], Column]
    results: Callable[[Column], Column]
    tools: Callable[[Column, Column], Column]


def react_tools(tools: Column, system: Column) -> Column:
    """The ReAct instructions; the system prompt is replaced by them."""
    name = lambda t: tool_field(t, "name")
    each = lambda t: F.concat(
        name(t), F.lit(": Call this tool to interact with the "), name(t), F.lit(" API. What is the "), name(t), F.lit(" API useful for? "),
        tool_field(t, "description"), F.lit(" Parameters: "), tool_field(t, "parameters"), F.lit(" Format the arguments as a JSON object."),
    )
    head = "Answer the following questions as best you can. You have access to the following tools:\n\n"
    rules = "\n\nUse the following format:\n\nQuestion: the input question you must answer\nThought: you should always think about what to do\nAction: the action to take, should be one of ["
    tail = (
        "]\nAction Input: the input to the action\nObservation: the result of the action\n"
        "... (this Thought/Action/Action Input/Observation can be repeated zero or more times)\nThought: I now know the final answer\n"
        "Final Answer: the final answer to the original input question\n\nBegin!\n"
    )
    return F.concat(F.lit(head), joined(tools, each, "\n\n"), F.lit(rules), joined(tools, name, ","), F.lit(tail))


def hermes_tools(tools: Column, system: Column) -> Column:
    head = "\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\nYou are provided with function signatures within <tools></tools> XML tags:\n<tools>\n"
    tail = (
        "\n</tools>\n\nFor each function call, return a json object with function name and arguments within <tool_call></tool_call> XML tags:\n"
        '<tool_call>\n{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call>'
    )
    return F.concat(F.coalesce(system, F.lit("")), F.lit(head), F.array_join(tools, "\n"), F.lit(tail))


def mistral_tools(tools: Column, system: Column) -> Column:
    return F.concat(F.coalesce(system, F.lit("")), F.lit("[AVAILABLE_TOOLS]"), F.array_join(tools, " "), F.lit("[/AVAILABLE_TOOLS]"))


def described_tools(tools: Column, system: Column) -> Column:
    """Each tool under a heading, with its description and parameters."""
    each = lambda t: F.concat(F.lit("### "), tool_field(t, "name"), F.lit("\nDescription: "), tool_field(t, "description"), F.lit("\nParameters: "), tool_field(t, "parameters"))
    return F.concat(F.coalesce(system, F.lit("")), F.lit("\n\n## Tools\nYou have access to the following tools:\n\n"), joined(tools, each, "\n\n"))


def react_calls(calls: Column) -> Column:
    return F.concat(joined(calls, lambda c: F.concat(F.lit(f"{ACTION} "), c["name"], F.lit(f"\n{ACTION_INPUT} "), c["arguments"], F.lit("\n")), ""), F.lit(OBSERVATION))


def react_results(results: Column) -> Column:
    """Each result on lines of its own; from the second on led by the keyword."""
    each = F.transform(results, lambda r, i: F.concat(F.when(i > 0, OBSERVATION).otherwise(""), r, F.when(F.endswith(r, F.lit("\n")), "").otherwise("\n")))
    return F.array_join(each, "")


# The marks of calls and results in public models' formats.
AGENTS = {
    "react": Agent(react_calls, react_results, react_tools),
    "hermes": Agent(
        lambda calls: joined(calls, lambda c: between("<tool_call>\n", as_object(c), "\n</tool_call>")),
        lambda results: joined(results, lambda r: between("<tool_response>\n", r, "\n</tool_response>")),
        hermes_tools,
    ),
    "hunyuan": Agent(
        lambda calls: between("<tool_calls>\n", joined(calls, lambda c: between("<tool_call>\n", as_object(c), "\n</tool_call>")), "\n</tool_calls>"),
        lambda results: between("<tool_responses>", joined(results, lambda r: between("<tool_response>", r, "</tool_response>")), "</tool_responses>"),
        hermes_tools,
    ),
    "mistral": Agent(
        lambda calls: between("[TOOL_CALLS][\n", joined(calls, as_object), "\n]</s>"),
        lambda results: joined(results, lambda r: between("[TOOL_RESULTS]", F.to_json(F.struct(r.alias("content"))), "[/TOOL_RESULTS]")),
        mistral_tools,
    ),
    "deepseek": Agent(
        lambda calls: between("<｜tool▁calls▁begin｜>", joined(calls, lambda c: F.concat(F.lit("<｜tool▁call▁begin｜>"), c["name"], F.lit("<｜tool▁sep｜>"), c["arguments"], F.lit("<｜tool▁call▁end｜>")), ""), "<｜tool▁calls▁end｜>"),
        lambda results: joined(results, lambda r: between("<｜tool▁output▁begin｜>", r, "<｜tool▁output▁end｜>"), ""),
        described_tools,
    ),
    "kimi": Agent(
        lambda calls: between("<|tool_calls_section_begin|>", joined(calls, lambda c: F.concat(F.lit("<|tool_call_begin|>"), c["name"], F.lit("<|tool_call_argument_begin|>"), c["arguments"], F.lit("<|tool_call_end|>")), ""), "<|tool_calls_section_end|>"),
        lambda results: joined(results, lambda r: r),
        described_tools,
    ),
    "qwen": Agent(
        lambda calls: joined(calls, lambda c: F.concat(F.lit("✿FUNCTION✿: "), c["name"], F.lit("\n✿ARGS✿: "), c["arguments"], F.lit("\n")), ""),
        lambda results: joined(results, lambda r: F.concat(F.lit("✿RESULT✿: "), r, F.lit("\n")), ""),
        described_tools,
    ),
    "youtu": Agent(
        lambda calls: joined(calls, lambda c: between("<tool_call>", as_object(c), "</tool_call>")),
        lambda results: joined(results, lambda r: between("<tool_response>", r, "</tool_response>")),
        hermes_tools,
    ),
}
#: Other names of the same formats.
AGENTS |= {"react_en": AGENTS["react"], "chatml_hermes": AGENTS["hermes"], "deepseek_v3_1": AGENTS["deepseek"], "kimi_k25": AGENTS["kimi"], "qwen_en": AGENTS["qwen"], "hunyuan_hermes": AGENTS["hunyuan"]}


def register(name: str, agent: Agent, exist_ok: bool = False) -> None:
    """Add a format; a name that is taken raises unless it may be replaced."""
    if name in AGENTS and not exist_ok:
        raise ValueError(f"the format {name!r} exists")
    AGENTS[name] = agent


def islands(messages: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Neighbouring messages that ``same`` (of one and the next) holds together, as arrays of messages; linear in their number."""

    def of(held: Column) -> Column:
        size = F.size(held)
        places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | ~F.coalesce(same(F.get(held, i - 1), F.get(held, i)), F.lit(False)))
        return bound(starts, lambda s: F.transform(s, lambda a, k: F.slice(held, a + 1, F.coalesce(F.get(s, k + 1), size) - a)))

    return bound(messages, of)


def first_set(run: Column, field: str) -> Column:
    """The first non-null of a field in a run of messages."""
    return F.get(F.filter(F.transform(run, lambda m: m[field]), lambda x: x.isNotNull()), F.lit(0))


def written_calls(messages: Column, agent: str = "hermes") -> Column:
    """Neighbouring ``tool_call`` messages as one assistant's message in the agent's format; the first weights that are given count."""
    runs = islands(messages, lambda a, b: (a["role"] == "tool_call") & (b["role"] == "tool_call"))
    content = lambda run: AGENTS[agent].calls(F.transform(run, lambda m: call_parts(m["content"])))

    def one(run: Column) -> Column:
        first = F.get(run, F.lit(0))
        made = F.struct(F.lit("assistant").alias("role"), content(run).alias("content"), first_set(run, "loss").alias("loss"), first_set(run, "loss_scale").alias("loss_scale"))
        return F.when(first["role"] == "tool_call", made).otherwise(first)

    return F.transform(runs, one).cast(MESSAGES)


def folded_results(messages: Column, agent: str = "hermes") -> Column:
    """Results that follow a user's message directly, without a call, become part of it."""
    tool = lambda m: m["role"].isin("tool", "tool_response")
    runs = islands(messages, lambda a, b: tool(b) & (a["role"].isin("user", "tool", "tool_response")))

    def parts(run: Column) -> Column:
        first = F.get(run, F.lit(0))
        rest = F.slice(run, F.lit(2), F.greatest(F.size(run) - 1, F.lit(0)))
        whole = F.concat(F.coalesce(first["content"], F.lit("")), AGENTS[agent].results(F.transform(rest, lambda m: m["content"])))
        merged = F.array(F.struct(first["role"].alias("role"), whole.alias("content"), first["loss"].alias("loss"), first["loss_scale"].alias("loss_scale")))
        return F.when((first["role"] == "user") & (F.size(run) > 1), merged).otherwise(run).cast(MESSAGES)

    return F.flatten(F.transform(runs, parts))


def even_rounds(messages: Column) -> Column:
    """A leading assistant gets an empty question before it, and an odd end an answer that is yet to come."""
    led = F.when(F.element_at(messages, 1)["role"] == "assistant", F.concat(F.array(message(F.lit("user"), F.lit(""))), messages)).otherwise(messages)
    return bound(led, lambda m: F.when(F.size(m) % 2 == 1, F.concat(m, F.array(message(F.lit("assistant"), F.lit(None).cast("string"))))).otherwise(m))


def plain_thinking(messages: Column, prefix: str, last_only: bool = False, after_user: bool = False, mark: str = "<think>") -> Column:
    """Assistants' answers without thinking get the prefix that says so: all, or those from the last question on, or right after a question."""
    from parley.functions.messages import last_user_round

    def add(held: Column) -> Column:
        start = last_user_round(held) if last_only else F.lit(-1)

        def each(m: Column, i: Column) -> Column:
            asked = F.coalesce(F.get(held, i - 1)["role"] == "user", F.lit(False)) if after_user else F.lit(True)
            bare = ~(F.startswith(m["content"], F.lit(mark)) | F.startswith(m["content"], F.lit(prefix)))
            return F.when((m["role"] == "assistant") & (i >= start) & asked & bare, m.withField("content", F.concat(F.lit(prefix), m["content"]))).otherwise(m)

        return F.transform(held, each)

    return bound(messages, add)


def placed_objects(text: Column, refs: Column, boxes: Column) -> Column:
    """'<ref-object>' and '<bbox>' replaced in order by names and by corners as '[(x1,y1),(x2,y2)]'; those left over stay as they are."""
    corner = lambda b, i: F.concat(F.lit("("), F.get(b, F.lit(2 * i)).cast("string"), F.lit(","), F.get(b, F.lit(2 * i + 1)).cast("string"), F.lit(")"))
    shown = F.transform(boxes, lambda b: F.concat(F.lit("["), F.when(F.size(b) >= 4, F.concat(corner(b, 0), F.lit(","), corner(b, 1))).otherwise(corner(b, 0)), F.lit("]")))

    def filled(out: Column, tag: str, values: Column) -> Column:
        each = lambda x: F.transform(x["p"], lambda p, i: F.concat(F.when(i == 0, "").otherwise(F.coalesce(F.get(x["v"], i - 1), F.lit(tag))), p))
        return bound(F.struct(F.split(out, tag).alias("p"), values.alias("v")), lambda x: F.array_join(each(x), ""))

    return filled(filled(text, "<ref-object>", refs), "<bbox>", shown)


def trained_ends(ids: Column, labels: Column, suffix: list[int], ignore: int = -100) -> Column:
    """Labels where the suffix that follows a trained span is trained on too, if the whole suffix stands there unmasked by a later span."""
    n = len(suffix)

    def of(x: Column) -> Column:
        i_, l_ = x["i"], x["l"]
        size = F.size(l_)
        # places where a masked run begins right after a trained token, and holds the whole suffix
        masked = lambda k: F.get(l_, k) == ignore
        fits = lambda k: (F.slice(i_, k + 1, F.lit(n)) == F.array(*[F.lit(t) for t in suffix])) & F.forall(F.slice(l_, k + 1, F.lit(n)), lambda v: v == ignore)
        starts = F.filter(F.sequence(F.lit(0), size - 1), lambda k: (k > 0) & masked(k) & (F.get(l_, k - 1) >= 0) & (k + n <= size) & fits(k))
        shown = bound(starts, lambda s: F.transform(l_, lambda v, k: F.when(F.exists(s, lambda a: (k >= a) & (k < a + n)), F.get(i_, k)).otherwise(v)))
        return F.when(size > 0, shown).otherwise(l_)

    return bound(F.struct(ids.alias("i"), labels.alias("l")), of)
