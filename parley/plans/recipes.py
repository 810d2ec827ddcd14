"""Queries of the recipes of public sets: their layouts are made from the tables, and conversations come back as digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import instruction_sets as texts
from parley.operators import media_sets as media
from parley.operators.instruction_sets import said
from parley.plans.registry import load, query


def docs(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    return load(spark, sf_dir, "documents").withColumns(columns)


def digest(messages: str = "messages") -> Column:
    """md5 of roles and contents."""
    return F.md5(F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\x01").cast("binary"))


def digested(df: DataFrame, *others: str) -> DataFrame:
    return df.select("doc_id", *others, digest().alias("messages"))


def as_sql(*turns: str) -> str:
    """The same in SQL; each turn is an expression that begins with the role."""
    return "md5(" + " || chr(1) || ".join(turns) + ")"


QA = as_sql("'user:' || {q}", "'assistant:' || {a}")


def qa(q: str, a: str = "text", where: str = "true", table: str = "documents") -> str:
    return f"select doc_id, {QA.format(q=q, a=a)} as messages from {table} where ({where}) and ({a}) is not null and ({q}) is not null"


@query("e01_alpaca_zh", qa("case when coalesce(source, '') = '' then lang else lang || chr(10) || source end"))
def e01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.alpaca_zh(docs(spark, sf_dir, instruction=F.col("lang"), input=F.concat(F.when(F.col("doc_id") % 2 == 0, "输入：").otherwise(""), F.col("source")), output=F.col("text")), "doc_id"))


@query(
    "e03_ruozhiba",
    """with t as (select doc_id, case when lang <> text then text || '，' || lang else text end w from documents where text is not null),
    c as (select doc_id, w, regexp_extract(w, '\\p{Nd}+[.,\\s、]([^\\n]+)', 1) g from t)
    select doc_id, md5('assistant:' || case when g <> '' then g else w end) as messages from c where w <> ''""",
)
def e03(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, title=F.when(F.col("doc_id") % 3 > 0, F.col("text")), content=F.col("text"), abs=F.col("lang")).where("text is not null and lang is not null")
    return digested(texts.ruozhiba(rows, "doc_id"))


@query("e04_math_trn", qa("source"))
def e04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.math_trn(docs(spark, sf_dir, query=F.col("source"), response=F.col("text")), "doc_id").where("size(messages) = 2"))


CONVERSATION = "with t as (select conv_id, turn, role, text from conversations), "


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation, messages in order of turn, role and text."""
    turns = load(spark, sf_dir, "conversations").where("role is not null and text is not null")
    held = F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    made = F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return turns.groupBy("conv_id").agg(held.alias("messages")).withColumn("messages", made)


CONV = "select conv_id, string_agg(role || ':' || text, chr(1) order by turn, role, text) k, lower(string_agg(text, chr(2))) low, count(*) n from conversations where role is not null and text is not null group by conv_id"


@query(
    "e05_without_marks",
    f"with c as ({CONV}) select conv_id, md5(k) as messages from c where not (contains(low, 'moss') or contains(low, 'human:') or contains(low, 'assistant:') or contains(low, 'user:'))",
)
def e05(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversations(spark, sf_dir)
    lead = F.concat(F.array(said("system", F.lit(texts.DEFAULT_SYSTEM))), "messages")
    found = found.withColumn("messages", F.when(F.col("conv_id") % 2 == 0, lead).otherwise(F.col("messages")))
    return texts.without_marks(found).select("conv_id", digest().alias("messages"))


@query("e06_many_plugins", "select doc_id from documents where lang is not null and source is not null and lang <> case when doc_id % 3 = 0 then lang else source end")
def e06(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(F.col("source"))
    system = F.concat(F.lit('1. {"plugin_name": "'), F.col("lang"), F.lit('"}\n2. {"plugin_name": "'), name, F.lit('"} '), F.coalesce(F.col("text"), F.lit("")))
    return texts.many_plugins(docs(spark, sf_dir, messages=F.array(said("system", system)))).select("doc_id")


@query("e08_text_to_sql", qa("'Sql Table information:' || chr(10) || source || chr(10) || lang", "'Let''s think step by step:' || chr(10) || text || chr(10) || 'So the final sql is:' || chr(10) || doc_id::varchar"))
def e08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.text_to_sql(docs(spark, sf_dir, sql_prompt=F.col("lang"), sql_context=F.col("source"), sql=F.col("doc_id").cast("string"), sql_explanation=F.col("text")), "doc_id").where("size(messages) = 2"))


@query("e09_two_turns", f"with c as ({CONV}) select conv_id, md5(replace(k, chr(1) || 'assistant:', chr(1) || 'assistant:')) as messages from c where n = 2")
def e09(spark: SparkSession, sf_dir: str) -> DataFrame:
    called = F.transform("messages", lambda m: F.struct(F.when((m["role"] == "assistant") & (F.col("conv_id") % 2 == 0), "caller").otherwise(m["role"]).alias("role"), m["content"].alias("content")))
    pairs = conversations(spark, sf_dir).withColumn("first", F.col("messages")[0]["role"]).withColumn("messages", F.when(F.col("first") == "user", called).otherwise(F.col("messages")))
    return texts.two_turns(pairs).select("conv_id", digest().alias("messages"))


@query("e10_blossom_math", qa("lang", "text || chr(10) || chr(10) || 'Answer: ' || n_chars::varchar"))
def e10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.blossom_math(docs(spark, sf_dir, query=F.col("lang"), output=F.col("text"), answer=F.col("n_chars").cast("string")), "doc_id").where("size(messages) = 2"))


@query(
    "e11_law_chapters",
    "select doc_id, md5('assistant:' || lang || chr(10) || source || chr(10) || case when doc_id % 2 = 0 then lang else '' end || source || text) as messages from documents where lang is not null and source is not null and text is not null",
)
def e11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, type=F.col("lang"), title=F.col("source"), chapter1=F.when(F.col("doc_id") % 2 == 0, F.col("lang")), chapter2=F.lit(None).cast("string"), chapter3=F.col("source"), response=F.col("text"))
    return digested(texts.law_chapters(rows, "doc_id"))


STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


@query("e12_python_solutions", qa("source || chr(10)", f"{STRIP.format(x="('```python' || chr(10) || text)")} || chr(10) || chr(10) || lang"))
def e12(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.concat(F.when(F.col("doc_id") % 2 == 0, "# ").otherwise(""), F.col("source"), F.lit("\n```python\n"), F.col("text"))
    return digested(texts.python_solutions(docs(spark, sf_dir, code_with_problem=whole, explanation_only=F.col("lang")), "doc_id").where("size(messages) = 2"))


@query("e13_sentence_pairs", "select doc_id, n_chars / 20000.0::double as label, md5('user:' || text) as messages, lang as positive from documents where n_chars / 20000.0::double >= 0.25 and text is not null")
def e13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, sentence1=F.col("text"), sentence2=F.col("lang"), score=F.col("n_chars") / 20000.0).where("text is not null")
    return texts.sentence_pairs(rows, "doc_id", threshold=0.25).select("doc_id", "label", digest().alias("messages"), F.col("positive_messages")[0][0]["content"].alias("positive"))


@query(
    "e14_scored_pairs",
    """with s as (select *, (doc_id % 51) / 10.0::double as score from documents where text is not null and lang is not null)
    select doc_id, md5('user:Task: Based on the given two sentences, provide a similarity score between 0.0 and 1.0.' || chr(10) || 'Sentence 1: ' || text || chr(10) || 'Sentence 2: ' || lang || chr(10) || 'Similarity score: '
      || chr(1) || 'assistant:' || ((doc_id % 51) // 10)::varchar || '.' || ((doc_id % 51) % 10)::varchar) as messages, score as label from s""",
)
def e14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, sentence1=F.col("text"), sentence2=F.col("lang"), score=(F.col("doc_id") % 51) / 10.0).where("text is not null and lang is not null")
    told = texts.scored_pairs(rows, "doc_id").select("doc_id", digest().alias("messages"))
    return told.join(texts.scored_pairs(rows, "doc_id", as_label=True).select("doc_id", "label"), "doc_id")


@query("e15_rerank_sets", "select doc_id, md5('user:' || text) as messages, 'assistant:' || lang as positive, 'assistant:' || source || '|assistant:' || lang as negatives from documents where text is not null and lang is not null and source is not null")
def e15(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, query=F.col("text"), positive=F.col("lang"), negative=F.array("source", "lang")).where("text is not null and lang is not null and source is not null")
    flat = lambda c: F.array_join(F.transform(c, lambda m: F.concat(m[0]["role"], F.lit(":"), m[0]["content"])), "|")
    return texts.rerank_sets(rows, "doc_id").select("doc_id", digest().alias("messages"), flat("positive_messages").alias("positive"), flat("negative_messages").alias("negatives"))


@query("e16_repaired_lists", "select doc_id, 2::bigint as n, lang as first, source as second from documents where lang is not null and source is not null")
def e16(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.concat(F.lit("["), F.to_json(F.struct(F.col("lang").alias("v"))), F.element_at(F.array(F.lit("\n "), F.lit("\n"), F.lit("")), (F.col("doc_id") % 3 + 1).cast("int")), F.to_json(F.struct(F.col("source").alias("v"))), F.lit("]"))
    found = docs(spark, sf_dir).where("lang is not null and source is not null").select("doc_id", F.from_json(texts.repaired(broken), "array<struct<v: string>>").alias("x"))
    return found.select("doc_id", F.size("x").cast("long").alias("n"), F.col("x")[0]["v"].alias("first"), F.col("x")[1]["v"].alias("second"))


@query(
    "e17_role_play",
    """with c as (select conv_id, arg_min(role, (turn, role, text)) fr, arg_min(text, (turn, role, text)) ft, arg_max(text, (turn, role, text)) lt, count(*) n
      from conversations where role is not null and text is not null group by conv_id)
    select conv_id, md5('system:' || chr(1) || 'user:' || ft || chr(1) || 'assistant:' || lt) as messages from c where fr = 'user' and ft <> '' and lt <> ''""",
)
def e17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.role_play(conversations(spark, sf_dir), "conv_id", conversations="messages").select("conv_id", digest().alias("messages"))


@query(
    "e18_countdown",
    """select doc_id, n_chars::bigint as target, md5('user:Using the numbers [' || doc_id::varchar || ', ' || (doc_id % 7)::varchar || '], create an equation that equals ' || n_chars::varchar || '.' || chr(10)
      || 'You can use basic arithmetic operations (+, -, *, /) and each number can only be used once.' || chr(10)
      || 'Show your work in <think> </think> tags. And return the final equation and answer in <answer> </answer> tags, for example <answer> (1 + 2) / 3 * 4 = 4 </answer>.') as messages from documents where n_chars is not null""",
)
def e18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.countdown(docs(spark, sf_dir, nums=F.array("doc_id", F.col("doc_id") % 7), response=F.col("n_chars")).where("n_chars is not null"), "doc_id"), "target")


@query("e20_question_generation", qa("'Task: Question Generation' || chr(10) || 'Context: ' || text || chr(10) || 'Answer: ' || lang || chr(10) || 'Question:'", "source", "not contains(text, '[SEP]')"))
def e20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.question_generation(docs(spark, sf_dir, text1=F.concat(F.col("lang"), F.lit("[SEP]"), F.col("text")), text2=F.col("source")), "doc_id").where("size(messages) = 2"))


@query(
    "e21_preference_dialogs",
    f"""with c as (select doc_id, {STRIP.format(x="text")} s, {STRIP.format(x="lang")} l from documents where text is not null and lang is not null and not regexp_matches(text, '\\n\\n(Human|Assistant|Hum):') and not starts_with({STRIP.format(x="text")}, 'Human:'))
    select doc_id, md5('user:' || l || chr(1) || 'assistant:' || s) as messages, md5('user:' || l || chr(1) || 'assistant:no') as rejected from c""",
)
def e21(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, chosen=F.concat(F.lit("\n\nHuman: "), F.col("lang"), F.lit(" \n\nAssistant: "), F.col("text"), F.lit("\n\nHum: bye")), rejected=F.concat(F.lit("\n\nHuman: "), F.col("lang"), F.lit("\n\nAssistant: no")))
    rows = rows.where(r"text is not null and lang is not null and not rlike(text, '\n\n(Human|Assistant|Hum):') and not startswith(regexp_replace(text, '^\\s+', ''), 'Human:')")
    return texts.preference_dialogs(rows, "doc_id").select("doc_id", digest().alias("messages"), digest("rejected_messages").alias("rejected"))


@query(
    "e22_function_calls",
    """select doc_id, md5('user:' || text || chr(1) || 'tool_call:{"name":"' || lang || '","arguments":{"n":' || n_chars::varchar || '}}' || chr(1) || 'tool_call:{"name":"' || source || '","arguments":{}}') as messages
    from documents where text is not null and lang is not null and source is not null and n_chars is not null""",
)
def e22(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.function_calls(call_rows(spark, sf_dir), "doc_id"))


def call_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = F.concat(F.lit('[{"name":"'), F.col("lang"), F.lit('","arguments":{"n":'), F.col("n_chars").cast("string"), F.lit('}},{"name":"'), F.col("source"), F.lit('","arguments":{}}]'))
    return docs(spark, sf_dir, query=F.col("text"), answers=answers, tools=F.lit("[]")).where("text is not null and answers is not null")


@query(
    "e23_one_function_call",
    "select count(*)::bigint as n, count(distinct doc_id)::bigint as ids from documents where text is not null and lang is not null and source is not null and n_chars is not null",
)
def e23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the calls is drawn depends on a hash that SQL lacks; that each is one of the row's own is checked here."""
    drawn = texts.one_function_call(call_rows(spark, sf_dir), "doc_id", "doc_id", "lang", "source", "n_chars")
    one = F.concat(F.lit("Action: "), F.col("lang"), F.lit('\nAction Input: {"n":'), F.col("n_chars").cast("string"), F.lit("}"))
    other = F.concat(F.lit("Action: "), F.col("source"), F.lit("\nAction Input: {}"))
    fine = drawn.where(F.col("solution").isin(one, other) & (F.col("messages")[1]["content"] == F.col("solution")))
    return fine.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))


@query("e24_chosen_appended", f"with c as ({CONV}) select conv_id, md5(k || chr(1) || 'assistant:yes') as messages, 'no' as rejected from c")
def e24(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir).withColumns({"chosen": said("assistant", F.lit("yes")), "rejected": said("assistant", F.lit("no"))})
    return texts.chosen_appended(rows, "conv_id").select("conv_id", digest().alias("messages"), F.col("rejected_response").alias("rejected"))


@query("e25_without_selectors", "select doc_id, md5(replace(text, chr(65039), '')) as text, source from documents")
def e25(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, text=F.concat(F.lit("️"), F.col("text")), source=F.concat(F.col("source"), F.lit("️")))
    return texts.without_selectors(rows, "text", "source").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text"), "source")


NO_MARKS = "not regexp_matches(text, '(User:|User：|Assistant：|Assistant:|Asssistent:|Assistent:|Assistenz:)')"


@query(
    "e26_marked_turns",
    f"""select doc_id, md5(case when doc_id % 3 = 0 then 'user:' || text || chr(1) || 'assistant:' || lang || chr(1) else '' end || 'user:' || case when doc_id % 3 = 0 then source else ' ' || source end || chr(1) || 'assistant:' || lang) as messages
    from documents where text <> '' and lang is not null and source is not null and doc_id % 3 < 2 and {NO_MARKS}""",
)
def e26(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("User:"), F.col("text"), F.lit("Assistenz:"), F.col("lang"))).when(F.col("doc_id") % 3 == 2, F.concat(F.lit("Assistant:"), F.col("text"))).otherwise("")
    rows = docs(spark, sf_dir, instruction=turns, input=F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("User: "), F.col("source"))).otherwise(F.concat(F.lit(" "), F.col("source"))), output=F.col("lang"))
    rows = rows.where("text <> '' and lang is not null and source is not null and not rlike(text, '(User:|User：|Assistant：|Assistant:|Asssistent:|Assistent:|Assistenz:)')")
    return digested(texts.marked_turns(rows, "doc_id"))


@query("e27_described_functions", f"with c as ({CONV}) select conv_id, md5(k) as messages, case when conv_id % 2 = 0 then 'a|b' end as tools from c")
def e27(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir).withColumns({"messages": F.concat(F.array(said("system", F.lit("s"))), "messages"), "function_description": F.when(F.col("conv_id") % 2 == 0, "a\n\nb").otherwise("")})
    return texts.described_functions(rows, "conv_id").select("conv_id", digest().alias("messages"), F.array_join("tools", "|").alias("tools"))


@query("e28_with_context", qa("case when coalesce(text, '') = '' then '' else 'Here gives some useful information:' || chr(10) || text || chr(10) end || lang", "source"))
def e28(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.with_context(docs(spark, sf_dir, instruction=F.col("lang"), context=F.col("text"), response=F.col("source")), "doc_id").where("size(messages) = 2"))


@query("e29_without_source", "select doc_id from documents where source is null or source <> 'src2'")
def e29(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.without_source(docs(spark, sf_dir), "src2").select("doc_id")


@query("n26_filled_prompt", qa("'Task: Generating advertisements based on keywords.' || chr(10) || 'Keywords: ' || source || chr(10) || 'Advertisements:'"))
def n26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(texts.advertisements(docs(spark, sf_dir, content=F.col("source"), summary=F.col("text")), "doc_id").where("size(messages) = 2"))


# --- sets with media -------------------------------------------------------------------------


@query(
    "m01_located_files",
    """with p as (select page_id, case when page_id % 3 = 0 then '/c/' || page_id::varchar || '.jpg' when page_id % 3 = 1 then '/o/ocr_vqa/' || page_id::varchar || '.jpg' else 'x/' || page_id::varchar || '.jpg' end f from pages)
    select page_id, f as path from p where f in (select f from p where page_id % 5 > 0)""",
)
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("page_id").cast("string")
    folder = F.when(F.col("page_id") % 3 == 0, "coco/").when(F.col("page_id") % 3 == 1, "ocr_vqa/").otherwise("x/")
    path = media.located(F.concat(folder, number, F.lit(".jpg")), {"coco": "/c", "ocr_vqa": "/o"})
    rows = load(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    out = media.all_existing(rows.withColumn("paths", F.array("path")), "paths", rows.where("page_id % 5 > 0"))
    return out.select("page_id", "path")


@query("m02_constant_question", qa("'What is the caption of this image?'"))
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(media.constant_question(docs(spark, sf_dir), media.CAPTION_QUESTION, "text", "doc_id"))


@query("m02_random_question", f"select doc_id, md5('assistant:' || case when doc_id % 2 = 0 then {STRIP.format(x='text')} else text end) as answer, 1::bigint as asked from documents where text is not null and (doc_id % 2 = 0 or not starts_with(text, 'This image displays:'))")
def m02_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, vlm=F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(media.PROSE_PREFIX + " "), F.col("text"))).otherwise(F.col("text"))).where("text is not null and (doc_id % 2 = 0 or not startswith(text, 'This image displays:'))")
    out = media.random_question(rows, media.PROSE_QUESTIONS, "doc_id", "vlm", "doc_id", prefix=media.PROSE_PREFIX)
    last = F.element_at("messages", 2)
    return out.select("doc_id", F.md5(F.concat(last["role"], F.lit(":"), last["content"]).cast("binary")).alias("answer"), F.element_at("messages", 1)["content"].isin(*media.PROSE_QUESTIONS).cast("long").alias("asked"))


@query("m02_dense_caption", "select doc_id, lang as caption from documents where lang is not null")
def m02_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    literal = F.concat(F.lit("{'global_caption': '"), F.col("lang"), F.lit("', 'n': 1}"))
    return docs(spark, sf_dir).where("lang is not null").select("doc_id", media.dense_caption(literal).alias("caption"))


@query("m02_spoken", qa("'语音转文本'", "replace(text, ' ', '')"))
def m02_spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(media.spoken(docs(spark, sf_dir), "text", "doc_id").where("size(messages) = 2"))


@query("m03_first_caption", qa("'please describe the image.'", "split_part(text, '&&', 1)"))
def m03(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, caption=F.when(F.col("doc_id") % 2 == 0, F.concat(F.col("text"), F.lit("&&"), F.col("source"))).otherwise(F.col("text"))).where("text is not null")
    return digested(media.first_caption(rows, "caption", "doc_id"))


@query("m04_options_question", "select doc_id, md5('user:' || text || chr(10) || lang || chr(10) || source || chr(1) || 'assistant:' || chr((65 + doc_id % 5)::integer)) as messages, (doc_id % 5)::integer as label from documents where text is not null and lang is not null and source is not null")
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, option=F.array("lang", "source"), response=(F.col("doc_id") % 5).cast("string")).where("text is not null and lang is not null and source is not null")
    told = digested(media.options_question(rows, "text", "option", "response", "doc_id"))
    return told.join(media.options_question(rows, "text", "option", "response", "doc_id", as_label=True).select("doc_id", "label"), "doc_id")


@query("m05_first_question", "select doc_id, case when doc_id % 3 = 0 then lang when doc_id % 3 = 1 then source else md5(text) end as question from documents")
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, query=F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise("None"), question_1=F.when(F.col("doc_id") % 3 == 1, F.col("source")), question_2=F.when(F.col("doc_id") % 3 == 2, F.md5(F.col("text").cast("binary"))))
    return rows.select("doc_id", media.first_question("query", "question_1", "question_2").alias("question"))


@query("m06_reference_pairs", "select doc_id, md5('user:<image>') as messages, md5(text) as positive from documents")
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, references=F.array("text", "lang"))
    return media.reference_pairs(rows, "references", "doc_id").select("doc_id", digest().alias("messages"), F.md5(F.col("positive_messages")[0][0]["content"].cast("binary")).alias("positive"))


@query("m08_grounded", "select doc_id, md5(text) as ref, round_even(n_chars / 4.0::double, 0)::integer as x, round_even(n_chars / 2.0::double, 0)::integer as y from documents")
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, captions=F.array("text"), bbox=F.array(F.col("n_chars") / 4.0, F.col("n_chars") / 2.0))
    box = F.col("objects")["bbox"][0]
    return media.grounded(rows, "captions", "bbox", "doc_id").select("doc_id", F.md5(F.col("objects")["ref"][0].cast("binary")).alias("ref"), box[0].alias("x"), box[1].alias("y"))


@query("m09_one_of_questions", "select doc_id, true as paired from documents where lang is not null and source is not null")
def m09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer come from the same place; which one is a matter of a hash that SQL lacks."""
    rows = docs(spark, sf_dir, questions=F.array("lang", "source"), answers=F.array(F.concat(F.lit("re: "), F.col("lang")), F.concat(F.lit("re: "), F.col("source")))).where("lang is not null and source is not null")
    m = F.col("messages")
    return media.one_of_questions(rows, "questions", "answers", "doc_id", "doc_id").select("doc_id", (m[1]["content"] == F.concat(F.lit("re: "), m[0]["content"])).alias("paired"))


@query("m10_chosen_option", qa("lang", "text || chr(10) || 'So the final answer is: ' || case when doc_id % 2 = 0 then lang else source end"))
def m10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(media.chosen_option(docs(spark, sf_dir, choices=F.array("lang", "source"), answer=F.col("doc_id") % 2), "lang", "choices", "answer", "text", "doc_id").where("size(messages) = 2"))


@query("m11_tagged_spans", "select doc_id, md5(substr(text, 1, 2) || '<ref-object><bbox>' || substr(text, 6, 3) || '<ref-object><bbox>' || substr(text, 13)) as tagged from documents where length(text) >= 12")
def m11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans 2 to 5 and 8 to 12 of every text that is long enough for both, the later one named first."""
    span = lambda a, b: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"))
    return docs(spark, sf_dir).where("length(text) >= 12").select("doc_id", F.md5(media.tagged_spans(F.col("text"), F.array(span(8, 12), span(2, 5))).cast("binary")).alias("tagged"))


@query(
    "m13_named_objects",
    "select doc_id, md5('user:Task: Object Detection' || chr(1) || 'assistant:<ref-object><bbox>' || chr(10) || '<ref-object><bbox>') as messages, case doc_id % 3 when 0 then 'person' when 1 then 'bicycle' else 'car' end || '|toothbrush' as names from documents",
)
def m13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir, category=F.array((F.col("doc_id") % 3).cast("int"), F.lit(79)))
    return media.named_objects(rows, "category", "doc_id").select("doc_id", digest().alias("messages"), F.array_join("ref", "|").alias("names"))


@query("m14_block_text", "select doc_id, md5(coalesce(text, '') || '<image>' || coalesce(lang, '')) as text from documents")
def m14(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = lambda kind, x: F.struct(F.lit(kind).alias("type"), x.alias("text"))
    blocks = F.array(block("text", F.coalesce(F.col("text"), F.lit(""))), block("image", F.lit(None).cast("string")), block("text", F.coalesce(F.col("lang"), F.lit(""))))
    return docs(spark, sf_dir).select("doc_id", F.md5(media.block_text(blocks).cast("binary")).alias("text"))


@query("m15_thinking_question", "select doc_id, md5('user:' || coalesce(text, '') || ' Output the thinking process in <think> </think> and final answer (number) in <answer> </answer> tags.' || chr(1) || 'assistant:' || source) as messages, source as solution from documents where source is not null")
def m15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digested(media.thinking_question(docs(spark, sf_dir), "text", "source", "doc_id"), "solution")


@query("m16_marked_classes", "select doc_id, array_to_string(list_filter([0, 1, 2, 3], lambda i: (doc_id // (i + 1)) % 2 = 1), ',') as classes from documents")
def m16(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = F.array(*[(F.floor(F.col("doc_id") / (i + 1)) % 2).cast("int") for i in range(4)])
    return docs(spark, sf_dir).select("doc_id", F.array_join(F.transform(media.marked_classes(marks), lambda i: i.cast("string")), ",").alias("classes"))


@query("m17_rooted_paths", "select page_id, case when page_id % 2 = 0 then '/abs' || url else '/data/' || url end as path from pages where url is not null")
def m17(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/abs"), "url")).otherwise(F.col("url"))
    return load(spark, sf_dir, "pages").where("url is not null").select("page_id", media.rooted(path, "/data/").alias("path"))
