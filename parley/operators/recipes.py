"""Recipes: raw layouts of public instruction sets made into queries and responses, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def picked(options: list[str], key: Column, seed: int = 42) -> Column:
    """One of the options, by a hash of the key."""
    return F.get(F.array(*[F.lit(o) for o in options]), F.pmod(F.xxhash64(F.lit(seed), key), F.lit(len(options))).cast("int"))


def without_prefix(text: Column, prefix: str) -> Column:
    """The text without the prefix, where it has it."""
    return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, len(prefix) + 1, 2**31 - 1)).otherwise(text)


def similar_pairs(df: DataFrame, a: str, b: str, score: str, threshold: float) -> DataFrame:
    """Pairs at or above the threshold, as ``anchor`` and ``positive``."""
    return df.where(F.col(score) >= threshold).select(F.col(a).alias("anchor"), F.col(b).alias("positive"))


def answers_exploded(df: DataFrame, query: str, answers: dict[str, int], key: str) -> DataFrame:
    """A row for each class of answers that is not empty: the query, one answer by hash, and the class as ``label``."""
    made = [F.struct(F.get(F.col(c), F.pmod(F.xxhash64(key), F.greatest(F.size(c), F.lit(1))).cast("int")).alias("answer"), F.lit(label).alias("label")) for c, label in answers.items()]
    rows = df.select(key, query, F.explode(F.array(*made)).alias("x")).select(key, query, "x.answer", "x.label")
    return rows.where("answer is not null")


def parted_dialog(text: Column, user: str = "Human", assistant: str = "Assistant") -> Column:
    """Contents of a dialog written as '\\n\\nHuman: ...\\n\\nAssistant: ...', trimmed; the first is the user's."""
    return F.transform(F.filter(F.split(text, rf"\n\n(?:{user}|{assistant}):"), lambda x: F.trim(x) != ""), lambda x: F.trim(x))


def chunked(text: Column, width: int, joint: str = "\n") -> Column:
    """The text cut after every ``width`` characters."""
    return F.regexp_replace(text, rf"(?s)(.{{{width}}})(?=.)", f"$1{joint}")


def filled(text: Column, values: dict[str, Column]) -> Column:
    """The text with each '{{NAME}}' replaced."""
    out = text
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), value)
    return out


def option_letter(index: Column) -> Column:
    """0, 1, 2, ... as A, B, C, ..."""
    return F.char(index + 65)


def existing_only(df: DataFrame, path: str, files: DataFrame, file_path: str = "path") -> DataFrame:
    """Rows whose file is listed."""
    return df.join(files.select(F.col(file_path).alias("__file")), F.col(path) == F.col("__file"), "left_semi")


def spans_apart(spans: Column) -> Column:
    """Whether no two of the (start, end) spans overlap."""
    ordered = F.array_sort(spans)
    pairs = F.zip_with(ordered, F.slice(ordered, F.lit(2), F.greatest(F.size(ordered) - 1, F.lit(0))), lambda a, b: F.struct(a["end"].alias("end"), b["start"].alias("start")))
    return F.forall(pairs, lambda p: F.coalesce(p["start"] >= p["end"], F.lit(True)))


def class_prompt(sentence: Column, labels: list[str], task: str) -> Column:
    """A classification task's prompt with its categories."""
    return F.concat(F.lit(f"Task: {task}\nSentence: "), sentence, F.lit("\nCategory: " + ", ".join(labels) + "\nOutput:"))
