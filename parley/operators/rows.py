"""Rows as objects: the contract of a preprocessor, bad rows, and views of a conversation for training, rewards and teachers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import messages as M
from parley.functions.bind import bound

SIDES = ("", "rejected_", "positive_", "negative_")
MEDIA = ("images", "videos", "audios")


def mapped(df: DataFrame, rows: Column, *keep: str) -> DataFrame:
    """The contract of a preprocessor: ``rows`` is an array of structs, of which each becomes a row; null or empty ones leave the row out."""
    name = "_made"
    return df.select(*keep, F.explode(rows).alias(name)).select(*keep, f"{name}.*")


def one(row: Column, where: Column | None = None) -> Column:
    """A row for ``mapped``: itself, or none where the condition fails."""
    made = F.array(row)
    return made if where is None else F.when(where, made)


def checked(df: DataFrame, checks: dict[str, Column], strict: bool = False, shown: int = 10) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and up to ``shown`` of the others with the first failed check as ``error``.

    A check that is null has failed. ``strict`` raises at the first bad row that is read.
    """
    error = F.coalesce(*[F.when(~F.coalesce(fine, F.lit(False)), F.lit(name)) for name, fine in checks.items()])
    told = df.withColumn("error", error)
    if strict:
        fine = F.when(F.col("error").isNull(), True).otherwise(F.raise_error(F.concat(F.lit("bad row: "), "error")).cast("boolean"))
        return told.where(fine).drop("error"), told.limit(0)
    return told.where("error is null").drop("error"), told.where("error is not null").limit(shown)


def literal_json(text: Column) -> Column:
    """A list or object written as a Python literal, as JSON; null where that is none. Strings in it must hold no quotes or escapes."""
    words = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    plain = F.replace(words, F.lit("'"), F.lit('"'))
    return F.when(F.try_parse_json(text).isNotNull(), text).otherwise(F.when(F.try_parse_json(plain).isNotNull(), plain))


def repaired_messages(text: Column, schema: str = "array<struct<role string, content string>>") -> Column:
    """Messages in JSON or as a literal, with missing commas put in; null where it can't be read."""
    whole = F.regexp_replace(text, r"\}\s*\{", "},{")
    return F.from_json(literal_json(whole), schema)


def class_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Labels as whole numbers; rows whose label is none are left out."""
    return df.withColumn(label, F.expr(f"try_cast(`{label}` as int)")).where(F.col(label).isNotNull())


def standard_input(df: DataFrame, messages: str = "messages") -> DataFrame:
    """A leading system prompt as a column of its own, and results of tools under one role; other columns stay.

    A media column and media in messages contradict each other only where both name the same file, so
    the columns that there are stay as they are.
    """
    first = F.get(F.col(messages), F.lit(0))
    led = F.coalesce(first["role"] == "system", F.lit(False))
    rest = F.when(led, F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(F.col(messages))
    renamed = F.transform(rest, lambda m: m.withField("role", F.when(m["role"] == "tool_response", "tool").otherwise(m["role"])))
    system = F.when(led, first["content"])
    if "system" in df.columns:
        system = F.coalesce(system, F.col("system"))
    return df.withColumns({"system": system, messages: renamed})


def sides(df: DataFrame) -> DataFrame:
    """The columns of each side of a pair in a struct: ``chosen``, ``rejected``, ``positive`` and ``negative``.

    What the rejected side lacks, it takes from the chosen one, if its messages come from a rejected
    response; ``rejected_messages`` of its own are left alone.
    """
    made = df
    inherited = "rejected_messages" not in df.columns and "rejected_response" in df.columns
    if inherited:
        made = made.withColumn("rejected_messages", M.chosen_and_rejected(F.col("messages"), F.col("rejected_response")))
    out = []
    for side, name in zip(SIDES, ("chosen", "rejected", "positive", "negative"), strict=True):
        own = [c for c in ("messages", "tools", "system", *MEDIA) if side + c in made.columns or inherited and side == "rejected_" and c in made.columns]
        if f"{side}messages" in made.columns:
            out.append(F.struct(*[F.col(side + c if side + c in made.columns else c).alias(c) for c in own]).alias(name))
    used = {s + c for s in SIDES for c in ("messages", "tools", "system", *MEDIA)} | {"rejected_response"}
    return made.select(*[c for c in df.columns if c not in used], *out)


def teacher_view(messages: Column, prompt: Column) -> Column:
    """The conversation with the teacher's prompt in place of the last question; where there is none, it stays."""

    def of(held: Column) -> Column:
        places = F.filter(F.transform(held, lambda m, i: F.when(m["role"] == "user", i)), lambda i: i.isNotNull())
        last = F.coalesce(F.array_max(places), F.lit(-1))
        return bound(last, lambda at: F.transform(held, lambda m, i: F.when((i == at) & prompt.isNotNull(), m.withField("content", prompt)).otherwise(m)))

    return bound(messages, of)


def teacher_images(own: Column, teacher: Column) -> Column:
    """The teacher's images: null means the student's, an empty list none."""
    return F.coalesce(teacher, own)


def reward_row(df: DataFrame, *private: str) -> DataFrame:
    """What a reward function is given: all columns but the private ones in one struct ``row``, and the completion."""
    completion = F.when(F.element_at("messages", -1)["role"] == "assistant", F.element_at("messages", -1)["content"])
    return df.select(completion.alias("completion"), F.struct(*[c for c in df.columns if c not in private]).alias("row"))


def from_reward_row(df: DataFrame) -> DataFrame:
    """The columns of ``reward_row`` back again."""
    return df.select("row.*")
