"""Loss weights of messages and of segments of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.bind import bound
from parley.functions.messages import last_user_round

STRATEGIES = ("default", "last_round", "all")


def message_weight(message: Column, index: Column, last_round: Column, strategy: str = "default") -> Column:
    """Weight of one message: its own ``loss`` and ``loss_scale`` win over the strategy's."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    assistant = message["role"].isin("assistant", "tool_call")
    trained = {"default": assistant, "last_round": assistant & (index >= last_round), "all": F.lit(True)}[strategy]
    trained = F.coalesce(message["loss"], trained)
    return F.when(trained, F.coalesce(message["loss_scale"], F.lit(1.0))).otherwise(F.lit(0.0))


def conversation_weights(messages: Column, strategy: str = "default") -> Column:
    """A weight for each message of a conversation."""
    return bound(messages, lambda held: bound(last_user_round(held), lambda last: F.transform(held, lambda m, i: message_weight(m, i, last, strategy))))


def split_by(text: Column, delimiters: list[str]) -> Column:
    """Segments of ``text``: (key, content), where key is the delimiter before the content, or empty. Joined again, they give the text."""
    import re

    either = "|".join(re.escape(d) for d in sorted(delimiters, key=len, reverse=True))
    keys = F.concat(F.array(F.lit("")), F.regexp_extract_all(text, F.lit(f"({either})"), F.lit(1)))
    contents = F.split(text, either, -1)
    parts = F.arrays_zip(keys.alias("key"), contents.alias("content"))
    return F.filter(parts, lambda p: (p["key"] != "") | (p["content"] != ""))


def segment_weights(text: Column, weights: dict[str, tuple[float, float]]) -> Column:
    """(content, weight) of the segments of ``text``: a delimiter's weights are its own and that of what follows; other text weighs 1."""

    def weighed(part: Column) -> Column:
        own, rest = F.lit(1.0), F.lit(1.0)
        for key, (first, second) in weights.items():
            own = F.when(part["key"] == key, F.lit(float(first))).otherwise(own)
            rest = F.when(part["key"] == key, F.lit(float(second))).otherwise(rest)
        return F.array(F.struct(part["key"].alias("content"), own.alias("weight")), F.struct(part["content"].alias("content"), rest.alias("weight")))

    return F.filter(F.flatten(F.transform(split_by(text, list(weights)), weighed)), lambda s: s["content"] != "")


#: The type of weighed segments.
SEGMENTS = "array<struct<content string, weight double>>"
# Weights of delimiters and of what follows them (two numbers), or of all that a pattern matches (one).
REACT = {"Action:": (2.0, 2.0), "Action Input:": (2.0, 2.0), "Thought:": (1.0, 1.0), "Final Answer:": (1.0, 1.0), "Observation:": (2.0, 0.0)}
CONFIGS = {
    "react": REACT,
    "alpha_umi": REACT | {"Next:": (2.0, 2.0)},
    "qwen": {"✿FUNCTION✿:": (2.0, 2.0), "✿ARGS✿:": (2.0, 2.0), "✿RETURN✿:": (1.0, 1.0), "✿RESULT✿:": (2.0, 0.0)},
    "hermes": {"<tool_call>.+?</tool_call>": (2.0,)},
    "agentflan": {
        "Name:": (1.0, 3.0), "Action:": (1.0, 3.0), "ACTION:": (1.0, 3.0), "Tool:": (1.0, 3.0), "Command": (1.0, 3.0), "Arguments:": (1.0, 3.0),
        "action input": (1.0, 3.0), "ACTION_INPUT:": (1.0, 3.0), "Action Input:": (1.0, 3.0), "Thought:": (1.0, 1.0), "Final Answer:": (1.0, 1.0),
        "Observation:": (2.0, 0.0),
    },
    "ignore_empty_think": {
        r"^<think>\s*</think>\s*": (0.0,),
        r"^<seed:think><seed:cot_budget_reflect>The current thinking budget is 0, so I will directly start answering the question.</seed:cot_budget_reflect>\n</seed:think>\s*": (0.0,),
        r"^</think>\s*": (0.0,),
        r"^<\|channel>thought\n<channel\|>": (0.0,),
        r"^</mm:think>\s*": (0.0,),
    },
    "ignore_think_prefix": {r"^<think>\n?": (0.0,)},
}
#: Of a configuration: weights of the whole response where the question holds a phrase; the first in order counts.
QUERIES = {
    "agentflan": {
        "What is the tool you want to use": 3.0,
        "What are the required parameter names": 3.0,
        "What is the value of": 3.0,
        "What are the required parameter names for this tool": 3.0,
    }
}
#: Configurations whose weights stand for more than yes and no, whatever they are.
GRADED = ("agentflan",)


def pattern_weights(text: Column, weights: dict[str, float]) -> Column:
    """(content, weight) of what the patterns match, and 1 for what lies between; matches don't overlap, and the first pattern that fits a place counts."""
    either = "(?s)" + "|".join(f"(?:{p})" for p in weights)
    found = F.regexp_extract_all(text, F.lit(f"(?s)({'|'.join(f'(?:{p})' for p in weights)})"), F.lit(1))
    between = F.split(text, either, -1)

    def weighed(match: Column) -> Column:
        out = F.lit(1.0)
        for pattern, weight in reversed(weights.items()):
            out = F.when(F.rlike(match, F.lit(rf"(?s)\A(?:{pattern})\z")), F.lit(float(weight))).otherwise(out)
        return out

    pairs = F.zip_with(between, found, lambda b, m: F.array(F.struct(b.alias("content"), F.lit(1.0).alias("weight")), F.struct(m.alias("content"), weighed(m).alias("weight"))))
    return F.filter(F.flatten(pairs), lambda s: F.coalesce(s["content"], F.lit("")) != "").cast(SEGMENTS)


def configured(text: Column, name: str, query: Column | None = None) -> Column:
    """Segments by one configuration; ``base`` leaves the text whole with weight 1. A phrase in the question decides alone."""
    whole = lambda w: F.array(F.struct(text.alias("content"), F.lit(w).alias("weight"))).cast(SEGMENTS)
    if name == "base":
        return whole(1.0)
    if name not in CONFIGS:
        raise ValueError(f"unknown loss weights {name!r}")
    config = CONFIGS[name]
    literal = {k: v for k, v in config.items() if len(v) == 2}
    out = segment_weights(text, literal).cast(SEGMENTS) if literal else pattern_weights(text, {k: v[0] for k, v in config.items()})
    for phrase, weight in reversed(QUERIES.get(name, {}).items() if query is not None else ()):
        out = F.when(F.contains(query, F.lit(phrase)), whole(weight)).otherwise(out)
    return out


def parsed_spec(spec: str) -> tuple[str, list[str]]:
    """Strategy and configurations of 'strategy+name+name'; without a strategy the default one, without names ``base``."""
    parts = spec.split("+")
    strategy, names = (parts[0], parts[1:] or ["base"]) if parts[0] in STRATEGIES else ("default", parts)
    for name in names:
        if name != "base" and name not in CONFIGS:
            raise ValueError(f"unknown loss weights {name!r}")
    return strategy, names


def chained(text: Column, names: list[str], query: Column | None = None) -> Column:
    """Segments by one configuration after another: each parts what the one before has left, and weights multiply."""

    def parted(segments: Column, name: str) -> Column:
        weighed = lambda s: lambda x: F.struct(x["content"].alias("content"), (x["weight"] * s["weight"]).alias("weight"))
        return F.flatten(F.transform(segments, lambda s: F.transform(configured(s["content"], name, query), weighed(s))))

    out = configured(text, names[0], query)
    for name in names[1:]:
        out = parted(out, name)
    return out


def is_binary(spec: str) -> bool:
    """Whether all weights are 0 or 1, so that labels alone tell what is trained on."""
    _, names = parsed_spec(spec)
    return all(name == "base" or name not in GRADED and all(w in (0.0, 1.0) for v in CONFIGS[name].values() for w in v) for name in names)
