"""Conversations in providers' formats made canonical, as column expressions over VARIANT values.

A conversation comes as JSON text, since the types of its contents vary from message to message: a
content is a text or a list of typed blocks. Blocks become pieces, neighbouring pieces of text and
media are joined, and tool calls and results stand alone. Locations of media are listed by their kind
in order, and what can't be read is said in ``error`` instead of failing the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.agents import islands
from parley.functions.bind import bound
from parley.functions.messages import MESSAGES

RAW = "array<struct<role string, content variant, tool_calls variant, loss boolean, loss_scale double>>"
NONE = "array<string>"
# Kinds of media, the blocks that hold them by location, and the formats' names.
MEDIA = ("image", "audio", "video")
FORMS = ("auto", "openai", "anthropic", "native")


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def kind_of(value: Column) -> Column:
    """'ARRAY', 'OBJECT', 'STRING' and so on; null for a missing value."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def listed(value: Column) -> Column:
    """Elements of a list; none of anything else."""
    return F.coalesce(F.when(kind_of(value) == "ARRAY", F.try_variant_get(value, "$", "array<variant>")), F.array().cast("array<variant>"))


def detected(messages: Column) -> Column:
    """'openai' if any message has tool calls, 'anthropic' if blocks of tools or of image sources occur, else 'native'."""
    block = lambda b: text_at(b, "$.type").isin("tool_use", "tool_result") | ((text_at(b, "$.type") == "image") & F.try_variant_get(b, "$.source", "variant").isNotNull())
    anthropic = F.exists(messages, lambda m: F.exists(listed(m["content"]), lambda b: F.coalesce(block(b), F.lit(False))))
    return F.when(F.exists(messages, lambda m: F.size(listed(m["tool_calls"])) > 0), "openai").when(anthropic, "anthropic").otherwise("native")


def call_text(name: Column, arguments: Column) -> Column:
    """A call as JSON; arguments that are JSON in a string are decoded, other strings stay, and missing ones are an empty object."""
    inner = F.try_parse_json(F.when(kind_of(arguments) == "STRING", F.try_variant_get(arguments, "$", "string")))
    given = F.coalesce(inner, arguments, F.parse_json(F.lit("{}")))
    return F.to_json(F.struct(name.alias("name"), given.alias("arguments")))


def location(block: Column) -> Column:
    """Where a block's media are: a location as such or under 'url', or a source with a location or encoded data."""
    kind = text_at(block, "$.type")
    own = [F.when(kind == f"{m}_url", F.coalesce(text_at(block, f"$.{m}_url.url"), text_at(block, f"$.{m}_url"))) for m in MEDIA]
    data = F.concat(F.lit("data:"), text_at(block, "$.source.media_type"), F.lit(";base64,"), text_at(block, "$.source.data"))
    return F.coalesce(*own, text_at(block, "$.source.url"), data)


def medium(block: Column) -> Column:
    """'image', 'audio' or 'video' of a block that holds one, else null."""
    name = F.regexp_replace(text_at(block, "$.type"), "_url$", "")
    return F.when(name.isin(*MEDIA) & location(block).isNotNull(), name)


def inner_blocks(block: Column) -> Column:
    """The block, or the blocks in a tool's result."""
    return F.when(text_at(block, "$.type") == "tool_result", listed(F.try_variant_get(block, "$.content", "variant"))).otherwise(F.array(block))


def located(messages: Column, kind: str) -> Column:
    """Locations of all media of a kind, in order."""
    blocks = F.flatten(F.transform(F.flatten(F.transform(messages, lambda m: listed(m["content"]))), inner_blocks))
    return F.transform(F.filter(blocks, lambda b: F.coalesce(medium(b) == kind, F.lit(False))), location)


def shown(block: Column) -> Column:
    """A block's text, or the tag of its medium; null of other blocks."""
    return F.coalesce(F.when(text_at(block, "$.type") == "text", text_at(block, "$.text")), F.concat(F.lit("<"), medium(block), F.lit(">")))


def result_text(block: Column) -> Column:
    """What a tool has given back: its text, its blocks' texts and tags, or JSON."""
    content = F.try_variant_get(block, "$.content", "variant")
    parts = F.array_join(F.transform(listed(content), lambda b: F.coalesce(shown(b), F.to_json(b))), "")
    return F.coalesce(F.when(kind_of(content) == "ARRAY", parts).when(kind_of(content) == "STRING", text_at(block, "$.content")), F.to_json(content), F.lit(""))


def pieces(message: Column) -> Column:
    """A message as canonical ones: what its blocks show, calls and results in their order, then the calls listed beside them."""
    own = lambda role, content: F.struct(role.alias("role"), content.alias("content"), message["loss"].alias("loss"), message["loss_scale"].alias("loss_scale"))

    def of_block(b: Column) -> Column:
        kind = text_at(b, "$.type")
        call = own(F.lit("tool_call"), call_text(text_at(b, "$.name"), F.try_variant_get(b, "$.input", "variant")))
        result = own(F.lit("tool_response"), result_text(b))
        return F.when(kind == "tool_use", call).when(kind == "tool_result", result).otherwise(own(message["role"], F.coalesce(shown(b), F.lit(""))))

    plain = lambda m: ~m["role"].isin("tool_call", "tool_response")
    runs = islands(F.transform(listed(message["content"]), of_block), lambda a, b: plain(a) & plain(b))
    whole = F.transform(runs, lambda run: own(run[0]["role"], F.array_join(F.transform(run, lambda m: m["content"]), "")))
    calls = F.when(message["role"] == "assistant", listed(message["tool_calls"])).otherwise(F.array().cast("array<variant>"))

    def of_call(c: Column) -> Column:
        inner = F.coalesce(F.try_variant_get(c, "$.function", "variant"), c)
        return own(F.lit("tool_call"), call_text(text_at(inner, "$.name"), F.try_variant_get(inner, "$.arguments", "variant")))

    text = F.when(kind_of(message["content"]) == "STRING", F.try_variant_get(message["content"], "$", "string"))
    lone = F.when((F.size(calls) > 0) & (F.coalesce(text, F.lit("")) == ""), F.array().cast(MESSAGES)).otherwise(F.array(own(message["role"], text)).cast(MESSAGES))
    return F.concat(F.when(kind_of(message["content"]) == "ARRAY", whole.cast(MESSAGES)).otherwise(lone), F.transform(calls, of_call).cast(MESSAGES))


def fault(messages: Column) -> Column:
    """What keeps a conversation from being read, or null."""
    known = lambda b: shown(b).isNotNull() | F.coalesce(text_at(b, "$.type").isin("tool_use", "tool_result"), F.lit(False))
    odd = F.filter(F.flatten(F.transform(messages, lambda m: listed(m["content"]))), lambda b: ~known(b))
    nameless = F.exists(messages, lambda m: m["role"].isNull())
    return F.when(messages.isNull() | nameless, "no list of messages with roles").when(F.size(odd) > 0, F.concat(F.lit("unknown block "), F.coalesce(text_at(odd[0], "$.type"), F.lit("without a type"))))


def normalized(column: Column, form: str = "auto") -> Column:
    """``messages``, ``images``, ``audios``, ``videos``, ``format`` and ``error`` of conversations in JSON.

    ``messages`` is null where ``error`` says why. A ``form`` other than ``auto`` is taken as given: the
    formats' blocks don't contradict each other, so it only sets ``format``.
    """
    if form not in FORMS:
        raise ValueError(f"unknown format {form!r}")

    def of(raw: Column) -> Column:
        error = fault(raw)
        made = F.when(error.isNull(), F.flatten(F.transform(raw, pieces)))
        return F.struct(
            made.alias("messages"), *[located(raw, k).alias(f"{k}s") for k in MEDIA], (detected(raw) if form == "auto" else F.lit(form)).alias("format"), error.alias("error")
        )

    return bound(F.from_json(column, RAW), of)


def same_object(a: Column, b: Column) -> Column:
    """Whether both texts are JSON objects, and equal whatever the order of their keys."""
    one, two = F.try_parse_json(a), F.try_parse_json(b)
    objects = (kind_of(one) == "OBJECT") & (kind_of(two) == "OBJECT")
    return F.coalesce(objects & (F.to_json(one) == F.to_json(two)), F.lit(False))


def action_reward(completion: Column, solution: Column) -> Column:
    """1.0 if the last ReAct calls of two texts have one name and equal JSON objects as inputs, else 0.0."""
    from parley.functions.toolcalls import react_calls

    last = lambda text: bound(react_calls(text), lambda calls: F.when(F.size(calls) > 0, F.element_at(calls, -1)))

    def same(x: Column) -> Column:
        return F.coalesce((x["a"]["name"] == x["b"]["name"]) & same_object(x["a"]["arguments"], x["b"]["arguments"]), F.lit(False)).cast("double")

    return bound(F.struct(last(completion).alias("a"), last(solution).alias("b")), same)
