"""Recipes of public instruction sets: raw layouts made into conversations, as projections and filters.

Each function takes a table in the set's own layout and gives ``messages`` (and what else the set has)
beside the columns named in ``keep``. Rows that a recipe can't use are left out, as is said of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.bind import bound
from parley.operators.recipes import chunked, filled, picked, without_prefix

ALPACA_ZH_PREFIX = "输入："
DEFAULT_SYSTEM = "You are a helpful assistant."
# What a conversation must not hold, and kinds that are kept.
MARKS = ("moss", "human:", "assistant:", "user:")
CALLERS = ("caller", "conclusion")
# Prompts and notes of the sets.
AD_PROMPT = "Task: Generating advertisements based on keywords.\nKeywords: {{QUERY}}\nAdvertisements:"
SIMILARITY_PROMPT = "Task: Based on the given two sentences, provide a similarity score between 0.0 and 1.0.\nSentence 1: {{A}}\nSentence 2: {{B}}\nSimilarity score: "
QUESTION_PROMPT = "Task: Question Generation\nContext: {{CONTEXT}}\nAnswer: {{ANSWER}}\nQuestion:"
NUMBERS_PROMPT = (
    "Using the numbers {{NUMBERS}}, create an equation that equals {{TARGET}}.\n"
    "You can use basic arithmetic operations (+, -, *, /) and each number can only be used once.\n"
    "Show your work in <think> </think> tags. And return the final equation and answer "
    "in <answer> </answer> tags, for example <answer> (1 + 2) / 3 * 4 = 4 </answer>."
)
ROOM_NOTES = "\n\n【注意事项】\n1. 这是聊天室，不要发送私信给任何人\n2. 仅代表你个人说话,不要扮演其他人，只根据对话历史进行回复\n3. 长话短说，不要说太多话，不要超过50字 "
ROOM_HISTORY = "\n\n【chat history】"
# Spellings that mark a turn in one set.
USER_MARKS = ("User:", "User：")
ASSISTANT_MARKS = ("Assistant：", "Assistant:", "Asssistent:", "Assistent:", "Assistenz:")


def said(role: str, content: Column) -> Column:
    """One message."""
    return F.struct(F.lit(role).alias("role"), content.cast("string").alias("content"))


def dialog(*messages: Column) -> Column:
    """Messages in order; those without content are left out."""
    return F.filter(F.array(*messages), lambda m: m["content"].isNotNull())


def stripped(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def asked(df: DataFrame, query: Column, response: Column, *keep: str) -> DataFrame:
    """A conversation of one question and answer; rows without an answer are left out."""
    return df.where(response.isNotNull()).select(*keep, dialog(said("user", query), said("assistant", response)).alias("messages"))


def alpaca_zh(df: DataFrame, *keep: str) -> DataFrame:
    """``instruction, input, output``: the input loses its label, and joins the instruction on a line of its own."""
    given = without_prefix(F.col("input"), ALPACA_ZH_PREFIX)
    parts = F.filter(F.array("instruction", given), lambda x: F.coalesce(x, F.lit("")) != "")
    return asked(df, F.array_join(parts, "\n"), F.col("output"), *keep)


def ruozhiba(df: DataFrame, *keep: str) -> DataFrame:
    """``title, content, abs``: text to pretrain on; a leading number goes. Empty ones are left out."""
    title = F.coalesce("title", "content")
    whole = F.when((F.coalesce("abs", F.lit("")) != "") & (F.col("abs") != title), F.concat(title, F.lit("，"), "abs")).otherwise(title)
    cut = bound(F.regexp_extract(whole, r"\p{Nd}+[.,\s、]([^\n]+)", 1), lambda x: F.when(x != "", x).otherwise(whole))
    return df.select(*keep, F.array(said("assistant", cut)).alias("messages")).where(F.coalesce(F.col("messages")[0]["content"], F.lit("")) != "")


def math_trn(df: DataFrame, *keep: str) -> DataFrame:
    """``query, response`` and nothing else."""
    return asked(df, F.col("query"), F.col("response"), *keep)


def without_marks(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Conversations without the default system prompt; those that mention another model or hold unparsed turns are left out."""
    first = F.element_at(messages, 1)
    plain = (first["role"] == "system") & (first["content"] == DEFAULT_SYSTEM)
    rest = F.when(plain, F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(F.col(messages))
    marked = F.exists(rest, lambda m: F.exists(F.array(*map(F.lit, MARKS)), lambda x: F.contains(F.lower(m["content"]), x)))
    return df.withColumn(messages, rest).where(~F.coalesce(marked, F.lit(False)))


def many_plugins(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Conversations whose system prompt lists more than one plugin."""
    first = F.element_at(messages, 1)
    names = F.regexp_extract_all(first["content"], F.lit(r'\p{Nd}\. \{"plugin_name": "(.+?)"'), F.lit(1))
    return df.where((first["role"] == "system") & (F.size(F.array_distinct(names)) > 1))


def advertisements(df: DataFrame, *keep: str) -> DataFrame:
    """``content, summary``: keywords in the prompt."""
    return asked(df, filled(F.lit(AD_PROMPT), {"QUERY": F.col("content")}), F.col("summary"), *keep)


def text_to_sql(df: DataFrame, *keep: str) -> DataFrame:
    """``sql_prompt, sql_context, sql, sql_explanation``."""
    query = F.concat(F.lit("Sql Table information:\n"), "sql_context", F.lit("\n"), "sql_prompt")
    return asked(df, query, F.concat(F.lit("Let's think step by step:\n"), "sql_explanation", F.lit("\nSo the final sql is:\n"), "sql"), *keep)


def two_turns(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Conversations of two turns, where a caller's or concluding turn is the assistant's; others are left out."""
    role = lambda m: F.when(m["role"].isin(*CALLERS), F.lit("assistant")).otherwise(m["role"])
    fixed = F.transform(messages, lambda m, i: F.struct(F.when(i == 1, role(m)).otherwise(m["role"]).alias("role"), m["content"].alias("content")))
    return df.where(F.size(messages) == 2).withColumn(messages, fixed)


def blossom_math(df: DataFrame, *keep: str) -> DataFrame:
    """``query, output, answer``."""
    return asked(df, F.col("query"), F.concat("output", F.lit("\n\nAnswer: "), "answer"), *keep)


def law_chapters(df: DataFrame, *keep: str) -> DataFrame:
    """``type, title, chapter1`` to ``chapter3`` and ``response``: one text to pretrain on, of those that there are."""
    text = F.concat("type", F.lit("\n"), "title", F.lit("\n"), F.concat_ws("", "chapter1", "chapter2", "chapter3"), "response")
    return df.where(text.isNotNull()).select(*keep, F.array(said("assistant", text)).alias("messages"))


def python_solutions(df: DataFrame, *keep: str) -> DataFrame:
    """``code_with_problem, explanation_only``: parted at the first fenced block; a heading's mark goes. Rows without code are left out."""
    whole, fence = F.col("code_with_problem"), "```python"
    at = F.instr(whole, fence)
    problem = F.substring(whole, F.lit(1), at - 1)
    code = stripped(F.substring(whole, at, F.lit(2**31 - 1)))
    return asked(df.where(at > 0), without_prefix(problem, "# "), F.concat(code, F.lit("\n\n"), "explanation_only"), *keep)


def sentence_pairs(df: DataFrame, *keep: str, threshold: float | None = None) -> DataFrame:
    """``sentence1, sentence2, score``: the second as positive of the first, from the threshold on."""
    rows = df if threshold is None else df.where(F.col("score") >= threshold)
    positive = F.array(F.array(said("user", F.col("sentence2"))))
    return rows.select(*keep, F.array(said("user", F.col("sentence1"))).alias("messages"), positive.alias("positive_messages"), F.col("score").cast("double").alias("label"))


def scored_pairs(df: DataFrame, *keep: str, as_label: bool = False) -> DataFrame:
    """The same as a task: the score as the answer with one decimal, or as ``label``."""
    query = filled(F.lit(SIMILARITY_PROMPT), {"A": F.col("sentence1"), "B": F.col("sentence2")})
    if as_label:
        return df.select(*keep, F.array(said("user", query)).alias("messages"), F.col("score").cast("double").alias("label"))
    return asked(df, query, F.format_string("%.1f", F.bround(F.col("score").cast("double"), 1)), *keep)


def listed(df: DataFrame, column: str) -> Column:
    """The column as an array, whether it is one or a single value."""
    return F.col(column) if df.schema[column].dataType.typeName() == "array" else F.array(column)


def rerank_sets(df: DataFrame, *keep: str) -> DataFrame:
    """``query, positive, negative``, each one or many."""
    each = lambda c: F.transform(listed(df, c), lambda x: F.array(said("assistant", x)))
    return df.select(*keep, F.array(said("user", F.col("query"))).alias("messages"), each("positive").alias("positive_messages"), each("negative").alias("negative_messages"))


def repaired(text: Column) -> Column:
    """A list of objects in JSON that lacks commas between them, with the commas."""
    return F.regexp_replace(text, r"\}\s*\{", "},{")


def role_play(df: DataFrame, *keep: str, conversations: str = "conversations") -> DataFrame:
    """Several speakers: what lies between the first and the last turn goes into the system prompt, the last is the answer.

    Rows whose first turn is not the user's ask nothing, and those with an empty question or answer are left out.
    """
    first, last = F.element_at(conversations, 1), F.element_at(conversations, -1)
    system = F.when(first["role"] == "system", first["content"]).otherwise(F.lit(""))
    noted = F.when(F.contains(system, F.lit("【注意事项】")) | (system == ""), system).otherwise(F.concat(system, F.lit(ROOM_NOTES)))
    middle = F.slice(conversations, F.lit(2), F.greatest(F.size(conversations) - 2, F.lit(0)))
    lines = F.array_join(F.transform(middle, lambda m: F.concat(F.lit("\n "), m["role"], F.lit(":"), m["content"])), "")
    asks = first["role"] == "user"
    whole = F.when(asks | F.contains(system, F.lit("next_speakers:")), system).otherwise(F.concat(noted, F.lit(ROOM_HISTORY), lines))
    query = F.when(asks, first["content"]).otherwise(F.lit(""))
    rows = df.where((query != "") & (last["content"] != ""))
    return rows.select(*keep, F.array(said("system", whole), said("user", query), said("assistant", last["content"])).alias("messages"))


def countdown(df: DataFrame, *keep: str) -> DataFrame:
    """``nums, response``: the numbers and the target in the prompt; the target stays as a column."""
    numbers = F.concat(F.lit("["), F.array_join(F.transform("nums", lambda n: n.cast("string")), ", "), F.lit("]"))
    query = filled(F.lit(NUMBERS_PROMPT), {"NUMBERS": numbers, "TARGET": F.col("response").cast("string")})
    return df.select(*keep, F.array(said("user", query)).alias("messages"), F.col("response").alias("target"))


def question_generation(df: DataFrame, *keep: str) -> DataFrame:
    """``text1`` as answer, '[SEP]' and context, ``text2`` as the question. Rows with other than two parts are left out."""
    parts = F.split("text1", r"\[SEP\]")
    query = filled(F.lit(QUESTION_PROMPT), {"CONTEXT": F.get(parts, F.lit(1)), "ANSWER": F.get(parts, F.lit(0))})
    return asked(df.where(F.size(parts) == 2), query, F.col("text2"), *keep)


def preference_dialogs(df: DataFrame, *keep: str) -> DataFrame:
    """``chosen, rejected`` as dialogs with 'Human:' and 'Assistant:' on lines of their own; a last question without an answer goes."""
    def turns(column: str) -> Column:
        parts = F.split(stripped(F.col(column)), r"\n\n(?:Human|Assistant|Hum):")
        clean = F.transform(parts, lambda p, i: stripped(F.when(i == 0, F.regexp_replace(p, r"^Human:", "")).otherwise(p)))
        even = F.slice(clean, F.lit(1), F.size(clean) - F.size(clean) % 2)
        return F.transform(even, lambda p, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), p.alias("content")))

    return df.select(*keep, turns("chosen").alias("messages"), turns("rejected").alias("rejected_messages"))


CALLS = "array<struct<name: string, arguments: string>>"


def function_calls(df: DataFrame, *keep: str) -> DataFrame:
    """``query, answers, tools``: a ``tool_call`` message for each call of a JSON list. Rows without a readable list are left out."""
    calls = F.from_json("answers", "array<string>")
    messages = F.concat(F.array(said("user", F.col("query"))), F.transform(calls, lambda c: said("tool_call", c)))
    return df.where(calls.isNotNull()).select(*keep, messages.alias("messages"), "tools")


def one_function_call(df: DataFrame, key: str, *keep: str, seed: int = 42) -> DataFrame:
    """The same with one call, drawn by a hash of the key, as a ReAct answer and ``solution``."""
    calls = F.from_json("answers", CALLS)
    drawn = F.get(calls, F.pmod(F.xxhash64(F.lit(seed), key), F.greatest(F.size(calls), F.lit(1))).cast("int"))
    rows = df.select(*{*keep, "query", "tools"}, drawn.alias("_drawn")).where("_drawn is not null")
    answer = F.concat(F.lit("Action: "), F.col("_drawn")["name"], F.lit("\nAction Input: "), F.col("_drawn")["arguments"])
    return rows.select(*keep, dialog(said("user", F.col("query")), said("assistant", answer)).alias("messages"), answer.alias("solution"), "tools")


def chosen_appended(df: DataFrame, *keep: str) -> DataFrame:
    """``messages, chosen, rejected`` (messages both): the chosen ends the conversation, the rejected is a response beside it."""
    return df.select(*keep, F.concat("messages", F.array("chosen")).alias("messages"), F.col("rejected")["content"].alias("rejected_response"))


def without_selectors(df: DataFrame, *columns: str) -> DataFrame:
    """The columns without the variation selector that emoji carry."""
    return df.withColumns({c: F.replace(F.col(c), F.lit("️"), F.lit("")) for c in columns})


def marked_turns(df: DataFrame, *keep: str) -> DataFrame:
    """``instruction, input, output``: turns of the instruction, told by their marks, come before the question and answer.

    Rows whose turns don't begin with the user's and alternate, or of which one is empty, are left out.
    """
    marks = "|".join(USER_MARKS + ASSISTANT_MARKS)
    text = F.coalesce("instruction", F.lit(""))
    keys = F.regexp_extract_all(text, F.lit(f"({marks})"), F.lit(1))
    parts = F.split(text, marks)
    turns = F.zip_with(keys, F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda k, p: F.struct(k.isin(*USER_MARKS).alias("user"), p.alias("content")))
    fine = F.forall(F.transform(turns, lambda t, i: (t["user"] == (i % 2 == 0)) & (t["content"] != "")), lambda ok: ok)
    fine = fine & (F.size(turns) % 2 == 0) & (F.get(parts, F.lit(0)) == "")
    given = F.when(F.startswith(F.col("input"), F.lit("User:")), stripped(F.substring("input", 6, 2**31 - 1))).otherwise(F.col("input"))
    history = F.transform(turns, lambda t: F.struct(F.when(t["user"], "user").otherwise("assistant").alias("role"), t["content"].alias("content")))
    return df.where(fine).select(*keep, F.concat(history, F.array(said("user", given), said("assistant", F.col("output")))).alias("messages"))


def described_functions(df: DataFrame, *keep: str) -> DataFrame:
    """``messages, function_description``: the descriptions, parted by empty lines, become ``tools``; a system prompt goes."""
    first = F.element_at("messages", 1)["role"] == "system"
    rest = F.when(first, F.slice("messages", F.lit(2), F.greatest(F.size("messages") - 1, F.lit(0)))).otherwise(F.col("messages"))
    tools = F.when(F.coalesce("function_description", F.lit("")) != "", F.split("function_description", "\n\n"))
    return df.select(*keep, rest.alias("messages"), tools.alias("tools"))


def with_context(df: DataFrame, *keep: str) -> DataFrame:
    """``instruction, context, response``: the context, if there is one, comes before the instruction."""
    given = F.when(F.coalesce("context", F.lit("")) != "", F.concat(F.lit("Here gives some useful information:\n"), "context", F.lit("\n"))).otherwise(F.lit(""))
    return asked(df, F.concat(given, "instruction"), F.col("response"), *keep)


def without_source(df: DataFrame, source: str = "toxic-dpo-v0.2", column: str = "source") -> DataFrame:
    """Rows of all other sources; those without a source stay."""
    return df.where(F.coalesce(F.col(column) != source, F.lit(True)))


def sudoku_rows(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """A board in lines of nine cells, '0' where it is empty."""
    return df.select(*keep, chunked(F.replace(F.col(column), F.lit("."), F.lit("0")), 9).alias("rows"))


def random_prompt(df: DataFrame, prompts: list[str], key: str, response: Column, *keep: str, seed: int = 42) -> DataFrame:
    """One of several questions, by a hash of the key, before a given answer."""
    return asked(df, picked(prompts, F.col(key), seed), response, *keep)
