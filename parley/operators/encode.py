"""Conversations made token rows for each kind of training, and batches of them, with any tokenizer.

A tokenizer is a function from a column of text to a column of ids: a built-in expression stays in
generated code, and ``python_tokenizer`` wraps a library in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.functions import messages as M
from parley.functions import sequences as S
from parley.functions.bind import bound
from parley.functions.weights import conversation_weights

Tokenizer = Callable[[Column], Column]
TASKS = ("causal_lm", "rlhf", "kto", "embedding", "reranker", "seq_cls")


@dataclass(frozen=True)
class Rounds:
    """A template by rounds. In a prompt '{{QUERY}}', '{{ROUND0}}' and '{{ROUND1}}' stand for the question and its number from 0 and 1.

    ``system_prefix`` holds '{{SYSTEM}}' and replaces ``prefix`` where there is a system prompt; ``last_prompt``
    holds it instead in formats that put it before the last question. Text that ends with a stop word
    gets no suffix.
    """

    prompt: str
    prefix: str = ""
    chat_sep: str | None = ""
    suffix: str = ""
    system_prefix: str | None = None
    last_prompt: str | None = None
    default_system: str | None = None
    stop_words: tuple[str, ...] = ()

    def bare(self) -> Rounds:
        """For plain continuation: the question alone."""
        return replace(self, prompt="{{QUERY}}", prefix="", chat_sep=None, suffix="", system_prefix=None, last_prompt=None, default_system=None)


# Marks of public chat formats.
ROUNDS = {
    "chatml": Rounds("<|im_start|>user\n{{QUERY}}<|im_end|>\n<|im_start|>assistant\n", "", "<|im_end|>\n", "<|im_end|>\n", "<|im_start|>system\n{{SYSTEM}}<|im_end|>\n", stop_words=("<|im_end|>",)),
    "llama2": Rounds("[INST] {{QUERY}} [/INST]", "<s>", "</s><s>", "</s>", "<s>[INST] <<SYS>>\n{{SYSTEM}}\n<</SYS>>\n\n"),
    "mistral_nemo": Rounds("[INST]{{QUERY}}[/INST]", "<s>", "</s>", "</s>", last_prompt="[INST]{{SYSTEM}}\n\n{{QUERY}}[/INST]"),
    "numbered": Rounds("[Round {{ROUND1}}]\n\nQ: {{QUERY}}\n\nA: ", "", "\n\n", ""),
}


def filled(pattern: str, values: dict[str, Column]) -> Column:
    """The pattern with its marks filled in, each searched for in the pattern alone and never in a value."""
    import re

    parts = re.split(r"(\{\{[A-Z0-9]+\}\})", pattern)
    return F.concat(*[values[p[2:-2]] if p[2:-2] in values and p.startswith("{{") else F.lit(p) for p in parts if p] or [F.lit("")])


def by_rounds(messages: Column, template: Rounds, train: bool = True) -> Column:
    """The conversation written round by round; without training it ends where the last answer begins."""

    def of(held: Column) -> Column:
        first = F.get(held, F.lit(0))
        system = F.when(first["role"] == "system", first["content"])
        if template.default_system is not None:
            system = F.coalesce(system, F.lit(template.default_system))
        pairs = M.history_pairs(held)

        def body(rounds: Column) -> Column:
            last = F.size(rounds) - 1

            def one(p: Column, i: Column) -> Column:
                values = {"QUERY": F.coalesce(p["query"], F.lit("")), "ROUND0": i.cast("string"), "ROUND1": (i + 1).cast("string"), "SYSTEM": F.coalesce(system, F.lit(""))}
                asked = filled(template.prompt, values)
                if template.last_prompt is not None:
                    asked = F.when((i == last) & system.isNotNull(), filled(template.last_prompt, values)).otherwise(asked)
                answer = F.coalesce(p["response"], F.lit(""))
                stopped = F.lit(False)
                for word in template.stop_words:
                    stopped = stopped | F.endswith(answer, F.lit(word))
                ended = F.when(stopped | p["response"].isNull(), "").otherwise(template.suffix)
                between = F.concat(asked, answer, F.when(i < last, template.chat_sep or "").otherwise(ended if train else F.lit("")))
                return between if train else F.when(i < last, between).otherwise(asked)

            return F.array_join(F.transform(rounds, one), "")

        lead = F.lit(template.prefix)
        if template.system_prefix is not None:
            lead = F.when(system.isNotNull(), filled(template.system_prefix, {"SYSTEM": system})).otherwise(lead)
        return F.concat(lead, bound(pairs, body))

    return bound(messages, of)


def word_ids(text: Column) -> Column:
    """A tokenizer for tests: a word's length as its id."""
    return F.transform(F.filter(F.split(text, r"\s+"), lambda w: w != ""), lambda w: F.length(w))


def python_tokenizer(encode: Callable[[list[str]], list[list[int]]]) -> Tokenizer:
    """A library's batch encoder as a tokenizer; null texts have no ids."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(encode([t or "" for t in texts]))

    return run


def encoded(messages: Column, tokenizer: Tokenizer, strategy: str = "default") -> Column:
    """``input_ids`` and ``labels`` of a conversation, message by message: what has no weight is not trained on, nor is the first token."""

    def of(held: Column) -> Column:
        parts = F.zip_with(held, conversation_weights(held, strategy), lambda m, w: F.struct(tokenizer(F.coalesce(m["content"], F.lit(""))).alias("ids"), w.alias("w")))
        ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
        labels = F.flatten(F.transform(parts, lambda p: F.when(p["w"] > 0, p["ids"]).otherwise(F.transform(p["ids"], lambda _: F.lit(S.IGNORE)))))
        return F.struct(ids.alias("input_ids"), S.masked_first(labels).alias("labels"))

    return bound(messages, of)


def encode(df: DataFrame, task: str, tokenizer: Tokenizer, *keep: str, strategy: str = "default") -> DataFrame:
    """Token columns for a task, and ``lengths`` of all sequences of a row.

    ``causal_lm``: ``input_ids`` and ``labels``. ``rlhf``: both with ``chosen_`` and ``rejected_`` before
    them; ``kto`` adds the row's ``label``. ``embedding``: ``sequences`` of anchor, positives and negatives,
    with ``labels`` 1 and 0 for all but the anchor. ``reranker``: a sequence of question and candidate each, labels 1 and 0.
    ``seq_cls``: ``input_ids`` without the answer, and the row's ``label``. Rows whose conversation is null are left out.
    """
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}")
    rows = df.where(F.col("messages").isNotNull())
    of = lambda m: encoded(m, tokenizer, strategy)
    ids = lambda m: of(m)["input_ids"]
    if task == "causal_lm":
        rows = rows.select(*keep, of(F.col("messages")).alias("x")).select(*keep, "x.*")
        return rows.withColumn("lengths", F.array(S.length(F.col("input_ids"))))
    if task in ("rlhf", "kto"):
        rejected = F.col("rejected_messages") if "rejected_messages" in df.columns else M.chosen_and_rejected(F.col("messages"), F.col("rejected_response"))
        label = ["label"] if task == "kto" else []
        rows = rows.select(*keep, *label, of(F.col("messages")).alias("c"), of(rejected).alias("r"))
        made = [F.col(f"{s}.{c}").alias(f"{n}_{c}") for s, n in (("c", "chosen"), ("r", "rejected")) for c in ("input_ids", "labels")]
        return rows.select(*keep, *label, *made).withColumn("lengths", F.array(S.length(F.col("chosen_input_ids")), S.length(F.col("rejected_input_ids"))))
    if task == "seq_cls":
        rows = rows.select(*keep, "label", ids(M.without_response(F.col("messages"))).alias("input_ids"))
        return rows.withColumn("lengths", F.array(S.length(F.col("input_ids"))))
    none = F.array().cast("array<array<struct<role string, content string>>>")
    many = lambda c: F.transform(F.coalesce(F.col(c), none) if c in df.columns else none, lambda m: F.transform(m, lambda x: M.message(x["role"], x["content"])))
    positive, negative = many("positive_messages"), many("negative_messages")
    anchor = F.transform("messages", lambda x: M.message(x["role"], x["content"]))
    if task == "embedding":
        sequences = F.concat(F.array(anchor), positive, negative)
    else:
        sequences = F.transform(F.concat(positive, negative), lambda c: F.concat(anchor, c))
    labels = F.concat(F.array_repeat(F.lit(1), F.size(positive)), F.array_repeat(F.lit(0), F.size(negative)))
    rows = rows.select(*keep, F.transform(sequences, ids).alias("sequences"), labels.alias("labels"))
    return rows.withColumn("lengths", F.transform("sequences", lambda s: F.size(s)))


def with_length(df: DataFrame, *arrays: str) -> DataFrame:
    """``length``: the longest of a row's arrays."""
    return df.withColumn("length", S.length(*[F.col(a) for a in arrays]))


def masked_chunks(df: DataFrame, size: int, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """Rows of at most ``size`` tokens each, numbered by ``chunk``; the first label of each is masked."""
    starts = F.when(F.size(ids) > 0, F.sequence(F.lit(1), F.size(ids), F.lit(size))).otherwise(F.array().cast("array<int>"))
    rest = [c for c in df.columns if c not in (ids, labels)]
    rows = df.select(*rest, ids, labels, F.posexplode(starts).alias("chunk", "_at"))
    cut = lambda c: F.slice(c, F.col("_at"), F.lit(size))
    return rows.select(*rest, "chunk", cut(ids).alias(ids), S.masked_first(cut(labels)).alias(labels))


def collated(df: DataFrame, batch: str, pad: int = 0, side: str = "right", multiple: int = 1, ids: str = "input_ids", labels: str = "labels") -> DataFrame:
    """Rows of a batch made equally long: ids, labels and an ``attention_mask``; the length is rounded up to a ``multiple``."""
    longest = df.groupBy(batch).agg((F.ceil(F.max(F.size(ids)) / multiple) * multiple).cast("int").alias("_size"))
    rows = df.join(longest, batch)
    size = F.col("_size")
    fill = lambda c, x: S.padded(F.col(c), size, F.lit(x), side)
    mask = S.padded(F.transform(ids, lambda _: F.lit(1)), size, F.lit(0), side)
    return rows.withColumns({"attention_mask": mask, ids: fill(ids, pad), labels: fill(labels, S.IGNORE)}).drop("_size")


def paired_batches(df: DataFrame, key: str, batch: str) -> DataFrame:
    """Chosen rows, then rejected ones of each batch, under common names with ``side``; a missing ``margin`` is 0."""
    margin = F.coalesce(F.col("margin"), F.lit(0.0)) if "margin" in df.columns else F.lit(0.0)
    side = lambda name, i: F.struct(F.lit(i).alias("side"), F.col(f"{name}_input_ids").alias("input_ids"), F.col(f"{name}_labels").alias("labels"))
    rows = df.select(key, batch, margin.alias("margin"), F.explode(F.array(side("chosen", 0), side("rejected", 1))).alias("x"))
    place = F.row_number().over(Window.partitionBy(batch).orderBy("x.side", key)) - 1
    return rows.withColumn("place", place).select(key, batch, "margin", "place", "x.*")
