"""Rows of any known layout made into canonical conversations.

Which layout a table has is told from its columns' names and types alone, without reading a row; all
conversion is column expressions, so unused columns are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from parley.functions import messages as M

# The canonical columns, and the names under which public datasets keep their parts.
CONTENTS = ("messages", "images", "videos", "audios", "tools", "objects")
STANDARD = tuple(p + c for p in ("", "rejected_", "positive_", "negative_") for c in CONTENTS) + (
    "rejected_response", "label", "channel", "margin", "teacher_prompt", "teacher_images", "chat_template_kwargs", "ref_audios", "audio_codes", "solution",
)
SYSTEM_NAMES = ("system", "system_prompt")
QUERY_NAMES = ("query", "prompt", "input", "instruction", "question", "problem")
RESPONSE_NAMES = ("response", "answer", "output", "targets", "target", "answer_key", "answers", "solution", "text", "completion", "content")
MESSAGE_NAMES = ("messages", "conversation", "conversations")
ROLE_KEYS, CONTENT_KEYS = ("role", "from"), ("content", "value")
USER_KEYS, ASSISTANT_KEYS = ("human", "user"), ("assistant", "gpt", "bot")


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Columns renamed whatever their case; a target that several columns claim is given to none."""
    lower = {old.lower(): new for old, new in mapping.items()}
    claims: dict[str, list[str]] = {}
    for c in df.columns:
        if c.lower() in lower:
            claims.setdefault(lower[c.lower()], []).append(c)
    renames = {old[0]: new for new, old in claims.items() if len(old) == 1 and old[0] != new}
    return df.withColumnsRenamed(renames)


def standard_columns(df: DataFrame) -> DataFrame:
    """The canonical columns that there are, in their order."""
    return df.select(*[c for c in STANDARD if c in df.columns])


def field_names(kind: DataType) -> list[str]:
    """Fields of the structs of an array."""
    return kind.elementType.names if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType) else []


def first_of(m: Column, names: list[str], wanted: tuple[str, ...]) -> Column:
    found = [m[n] for n in wanted if n in names]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def standard_messages(column: str, kind: DataType, system: Column | None = None) -> Column:
    """Messages of one of the known layouts: role and content under other names, or pairs of sides."""
    names = field_names(kind)
    c = F.col(column)
    optional = lambda m, n, t: (m[n] if n in names else F.lit(None)).cast(t).alias(n)
    if any(n in names for n in ROLE_KEYS):
        def one(m: Column) -> Column:
            role = M.standard_role(first_of(m, names, ROLE_KEYS))
            return F.struct(role.alias("role"), first_of(m, names, CONTENT_KEYS).alias("content"), optional(m, "loss", "boolean"), optional(m, "loss_scale", "double"))

        out = F.transform(c, one)
    elif any(n in names for n in USER_KEYS) and any(n in names for n in ASSISTANT_KEYS):
        out = M.from_history(F.transform(c, lambda p: F.struct(first_of(p, names, USER_KEYS).alias("query"), first_of(p, names, ASSISTANT_KEYS).alias("response"))))
    else:
        raise ValueError(f"{column!r} holds no known layout of messages: {names}")
    return out if system is None else M.with_system(out, system)


def messages_preprocess(df: DataFrame) -> DataFrame:
    """Rows that hold conversations; rejected ones are treated alike, and empty ones become null. Invalid rows go."""
    name = next(c for c in MESSAGE_NAMES if c in df.columns)
    system = next((F.col(c) for c in SYSTEM_NAMES if c in df.columns), None)
    out = df.withColumn("messages", standard_messages(name, df.schema[name].dataType, system))
    if "rejected_messages" in df.columns:
        rejected = standard_messages("rejected_messages", df.schema["rejected_messages"].dataType)
        out = out.withColumn("rejected_messages", F.when(F.size("rejected_messages") > 0, rejected))
    return valid_rows(out)


def response_preprocess(df: DataFrame) -> DataFrame:
    """Rows of a system prompt, earlier rounds, a query and a response, each optional, under their usual names."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    pick = lambda names: next((F.col(f"`{lower[n]}`") for n in names if n in lower), None)
    system, query, response = pick(SYSTEM_NAMES), pick(QUERY_NAMES), pick(RESPONSE_NAMES)
    parts = []
    if "history" in df.columns:
        pairs = F.transform("history", lambda p: F.struct(F.get(p, F.lit(0)).alias("query"), F.get(p, F.lit(1)).alias("response")))
        parts.append(F.coalesce(M.from_history(pairs), F.array().cast(M.MESSAGES)))
    none = F.lit(None).cast("string")
    if response is not None and isinstance(df.select(response).schema[0].dataType, ArrayType):
        response = F.get(response, F.lit(0))
    last = F.struct((none if query is None else query.cast("string")).alias("query"), (none if response is None else response.cast("string")).alias("response"))
    parts.append(M.from_history(F.array(last)))
    messages = reduce(lambda a, b: F.concat(a, b), parts)
    return valid_rows(df.withColumn("messages", messages if system is None else M.with_system(messages, system)))


def alpaca_preprocess(df: DataFrame) -> DataFrame:
    """Rows of instruction, input and output: the first two joined by a line feed where both are there."""
    a, b = F.nullif(F.col("instruction"), F.lit("")), F.nullif(F.col("input"), F.lit(""))
    query = F.when(a.isNotNull() & b.isNotNull(), F.concat(a, F.lit("\n"), b)).otherwise(F.coalesce(a, b))
    out = df.withColumn("__query", query).where("__query is not null").drop("instruction", "input").withColumnRenamed("__query", "query")
    return response_preprocess(out)


def auto_preprocess(df: DataFrame) -> DataFrame:
    """The layout by the columns' names: conversations, then alpaca, then query and response."""
    names = {c.lower() for c in df.columns}
    if any(n in names and not isinstance(df.schema[n].dataType, StringType) for n in MESSAGE_NAMES if n in df.columns):
        return messages_preprocess(df)
    if {"instruction", "input"} <= names:
        return alpaca_preprocess(df)
    return response_preprocess(df)


def valid_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows whose conversation is valid, and whose rejected answer, if any, differs from the given one; ``strict`` fails at the first other row."""
    fine = M.is_valid(F.col("messages"))
    if "rejected_response" in df.columns:
        last = F.element_at("messages", -1)["content"]
        fine &= F.col("rejected_response").isNotNull() & ~last.eqNullSafe(F.col("rejected_response").cast("string"))
    if strict:
        return df.where(F.when(fine, True).otherwise(F.raise_error(F.lit("a row holds no valid conversation")).cast("boolean")))
    return df.where(fine)


def openai_calls(content: Column, calls: Column) -> Column:
    """Messages of an assistant's turn with tool calls: its text, if any, then one ``tool_call`` of name and arguments for each call."""
    one = lambda c: F.to_json(F.struct(c["function"]["name"].alias("name"), F.try_parse_json(c["function"]["arguments"]).alias("arguments")))
    made = F.transform(calls, lambda c: M.message(F.lit("tool_call"), one(c)))
    lead = F.when(F.length(content) > 0, F.array(M.message(F.lit("assistant"), content))).otherwise(F.array().cast(M.MESSAGES))
    return F.concat(lead, made)


def checked_boxes(boxes: Column) -> Column:
    """Boxes of two points with the smaller coordinate first in each; points and null stay."""
    four = lambda b: F.array(F.least(b[0], b[2]), F.least(b[1], b[3]), F.greatest(b[0], b[2]), F.greatest(b[1], b[3]))
    return F.transform(boxes, lambda b: F.when(F.size(b) == 4, four(b)).when(F.size(b) == 2, b).otherwise(F.raise_error(F.lit("a box has 2 or 4 numbers")).cast("array<double>")))


def media_list(column: Column, kind: DataType) -> Column:
    """Images as an array of (bytes, path): paths, lone or listed, are wrapped."""
    wrap = lambda p: F.struct(F.lit(None).cast("binary").alias("bytes"), p.alias("path"))
    if isinstance(kind, StringType):
        return F.when(column.isNotNull(), F.array(wrap(column)))
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
        return F.transform(column, wrap)
    return column


def image_tags(text: Column) -> tuple[Column, Column]:
    """Text with '<img>path</img>' made '<image>', and the paths."""
    pattern = r"<img>(.+?)</img>"
    return F.regexp_replace(text, pattern, "<image>"), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
