"""Column expressions over conversations: arrays of ``role, content, loss, loss_scale``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.bind import bound

#: The canonical type of a conversation.
MESSAGES = "array<struct<role string, content string, loss boolean, loss_scale double>>"

# The roles a valid conversation may hold.
ROLES = ("system", "user", "tool_call", "tool_response", "tool", "assistant")
# Other names of roles in public chat formats.
ROLE_NAMES = {
    "user": ("user", "human"),
    "assistant": ("assistant", "gpt", "bot"),
    "tool_call": ("tool_call", "function_call"),
    "tool_response": ("tool_response", "function_response", "observation", "observations"),
}


def of_turns(turn: str = "turn", role: str = "role", content: str = "text") -> Column:
    """Aggregate: the conversation of rows in long form, in the order of their turns."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(turn), F.col(role).alias("role"), F.col(content).alias("content"))))
    return F.transform(rows, lambda t: message(t["role"], t["content"]))


def message(role: Column, content: Column) -> Column:
    """One message in canonical form."""
    return F.struct(role.alias("role"), content.alias("content"), F.lit(None).cast("boolean").alias("loss"), F.lit(None).cast("double").alias("loss_scale"))


def is_valid(messages: Column) -> Column:
    """Not empty, known roles only, and no missing content; false for null."""
    fine = F.forall(messages, lambda m: m["role"].isin(*ROLES) & m["content"].isNotNull())
    return F.coalesce((F.size(messages) > 0) & fine, F.lit(False))


def standard_role(role: Column) -> Column:
    """The canonical name of a role; hyphens count as underscores, unknown names stay."""
    name = F.replace(role, F.lit("-"), F.lit("_"))
    out = role
    for canonical, names in ROLE_NAMES.items():
        out = F.when(name.isin(*names), F.lit(canonical)).otherwise(out)
    return out


def with_system(messages: Column, system: Column) -> Column:
    """``messages`` led by a system message, unless there is one or none is given."""
    has = F.get(messages, F.lit(0))["role"] == "system"
    return F.when(system.isNull() | F.coalesce(has, F.lit(False)), messages).otherwise(F.concat(F.array(message(F.lit("system"), system)), messages))


def last_user_round(messages: Column) -> Column:
    """Index, from 0, of the last user or tool message; -1 if there is none."""
    hits = F.filter(F.transform(messages, lambda m, i: F.when(m["role"].isin("user", "tool"), i)), lambda i: i.isNotNull())
    return F.coalesce(F.array_max(hits), F.lit(-1))


def without_response(messages: Column) -> Column:
    """The conversation without a final assistant message."""
    ends = F.element_at(messages, -1)["role"] == "assistant"
    return F.when(ends, F.slice(messages, F.lit(1), F.size(messages) - 1)).otherwise(messages)


def response(messages: Column) -> Column:
    """Content of a final assistant message, or null."""
    last = F.element_at(messages, -1)
    return F.when(last["role"] == "assistant", last["content"])


def history_pairs(messages: Column) -> Column:
    """(query, response) pairs of the messages after a system message; an odd tail has a null response."""
    def of(body: Column) -> Column:
        rounds = F.when(F.size(body) > 0, F.sequence(F.lit(0), F.floor((F.size(body) - 1) / 2).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.transform(rounds, lambda i: F.struct(F.get(body, 2 * i)["content"].alias("query"), F.get(body, 2 * i + 1)["content"].alias("response")))

    return bound(F.filter(messages, lambda m: m["role"] != "system"), of)


def from_history(pairs: Column) -> Column:
    """Messages of (query, response) pairs; null sides are left out."""
    both = lambda p: F.array(message(F.lit("user"), p["query"]), message(F.lit("assistant"), p["response"]))
    return F.filter(F.flatten(F.transform(pairs, both)), lambda m: m["content"].isNotNull())


def as_query(messages: Column) -> Column:
    """'User: ...' and 'Assistant: ...' lines of a conversation; empty contents and other roles are left out."""
    named = F.transform(
        F.filter(messages, lambda m: m["role"].isin("user", "assistant", "system") & (F.length(m["content"]) > 0)),
        lambda m: F.concat(F.initcap(m["role"]), F.lit(": "), m["content"]),
    )
    return F.array_join(named, "\n")


def merged(messages: Column, joint: str = "") -> Column:
    """Neighbouring messages of one role made one, contents joined by ``joint``."""

    def step(acc: Column, m: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        longer = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(message(last["role"], F.concat(last["content"], F.lit(joint), m["content"]))))
        return F.when((F.size(acc) > 0) & (last["role"] == m["role"]), longer).otherwise(F.concat(acc, F.array(message(m["role"], m["content"]))))

    return F.aggregate(messages, F.array().cast(MESSAGES), step)


def chosen_and_rejected(messages: Column, rejected: Column) -> Column:
    """The rejected conversation: what leads up to the last user or tool message, then ``rejected``."""
    return F.concat(F.slice(messages, F.lit(1), last_user_round(messages) + 1), F.array(message(F.lit("assistant"), rejected)))
