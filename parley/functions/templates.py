"""Chat templates as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How the parts of a conversation are written: ``{content}`` stands for a message's text."""

    system: str
    user: str
    assistant: str
    suffix: str = ""
    tool: str | None = None
    default_system: str | None = None
    start: str = ""


# The marks of public chat formats.
CHATML = Template("<|im_start|>system\n{content}<|im_end|>\n", "<|im_start|>user\n{content}<|im_end|>\n<|im_start|>assistant\n", "{content}", "<|im_end|>\n")
LLAMA3 = Template(
    "<|start_header_id|>system<|end_header_id|>\n\n{content}<|eot_id|>",
    "<|start_header_id|>user<|end_header_id|>\n\n{content}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
    "{content}",
    "<|eot_id|>",
    start="<|begin_of_text|>",
)
PLAIN = Template("{content}\n", "User: {content}\nAssistant: ", "{content}", "\n")
TEMPLATES = {"chatml": CHATML, "llama3": LLAMA3, "plain": PLAIN}


def fill(pattern: str, content: Column) -> Column:
    """``pattern`` with ``{content}`` filled in; the content is never searched for marks."""
    before, _, after = pattern.partition("{content}")
    return F.concat(F.lit(before), content, F.lit(after))


def render(messages: Column, template: Template = CHATML, train: bool = True) -> Column:
    """The conversation as training text, or as a prompt: without training, what follows the last user message is left out."""
    tool = template.tool or template.user

    def part(m: Column) -> Column:
        role, content = m["role"], m["content"]
        out = F.when(role == "system", fill(template.system, content)).when(role == "user", fill(template.user, content))
        out = out.when(role.isin("tool", "tool_response"), fill(tool, content))
        return out.otherwise(fill(template.assistant + template.suffix, content))

    shown = messages
    if not train:
        shown = F.when(F.element_at(messages, -1)["role"] == "assistant", F.slice(messages, F.lit(1), F.size(messages) - 1)).otherwise(messages)
    body = F.array_join(F.transform(shown, part), "")
    if template.default_system is not None:
        led = F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))
        body = F.when(led, body).otherwise(F.concat(F.lit(template.system.replace("{content}", template.default_system)), body))
    return F.concat(F.lit(template.start), body)


def strip_thinking(messages: Column) -> Column:
    """Assistant messages before the last user message lose everything up to '</think>'."""
    from parley.functions.messages import last_user_round

    last = last_user_round(messages)
    return F.transform(
        messages,
        lambda m, i: F.when(
            (m["role"] == "assistant") & (i < last) & F.contains(m["content"], F.lit("</think>")),
            m.withField("content", F.trim(F.substring_index(m["content"], "</think>", -1))),
        ).otherwise(m),
    )
