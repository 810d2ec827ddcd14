"""Queries of agent formats, template steps and chained loss weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import agents, toolcalls, weights
from parley.functions.messages import MESSAGES, message
from parley.plans.recipes import digest
from parley.plans.registry import load, query

FULL = "text is not null and lang is not null and source is not null and n_chars is not null"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where(FULL)


def turns(*pairs: tuple[str, Column]) -> Column:
    return F.array(*[message(F.lit(role), content) for role, content in pairs]).cast(MESSAGES)


def call() -> Column:
    """A call in JSON with the row's language as name and its length as argument."""
    return F.concat(F.lit('{"name": "'), F.col("lang"), F.lit('", "arguments": {"n": '), F.col("n_chars").cast("string"), F.lit("}}"))


def md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


CALL = "'{\"name\": \"' || lang || '\", \"arguments\": {\"n\":' || n_chars::varchar || '}}'"
HERMES_CALL = f"'<tool_call>' || chr(10) || {CALL} || chr(10) || '</tool_call>'"


@query("t05_even_rounds", f"select doc_id, md5(case when doc_id % 2 = 0 then 'user:' || chr(1) else '' end || case when doc_id % 2 = 0 then 'assistant:' else 'user:' end || text) as messages, (doc_id % 2 = 1) as waiting from documents where {FULL}")
def even_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.when(F.col("doc_id") % 2 == 0, turns(("assistant", F.col("text")))).otherwise(turns(("user", F.col("text"))))
    out = docs(spark, sf_dir).select("doc_id", agents.even_rounds(held).alias("m"))
    shown = F.filter("m", lambda x: x["content"].isNotNull())
    return out.select("doc_id", digest(shown).alias("messages"), (F.element_at("m", -1)["content"].isNull()).alias("waiting"))


TOOL = "'{\"name\":\"' || lang || '\",\"description\":\"' || source || '\",\"parameters\":{\"type\":\"object\"}}'"


def tool() -> Column:
    return F.concat(F.lit('{"name":"'), F.col("lang"), F.lit('","description":"'), F.col("source"), F.lit('","parameters":{"type":"object"}}'))


@query("t06_wrapped_tools", f"select doc_id, '{{\"type\":\"function\",\"function\":' || {TOOL} || '}}' as tool, lang as name, source as description, 2::bigint as n from documents where {FULL}")
def wrapped_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit('{"type":"function","function":'), tool(), F.lit("}"))
    listed = F.concat(F.lit("["), F.when(F.col("doc_id") % 2 == 0, tool()).otherwise(wrapped), F.lit(","), tool(), F.lit("]"))
    out = docs(spark, sf_dir).select("doc_id", agents.listed_tools(listed).alias("t"))
    first = F.element_at("t", 1)
    return out.select("doc_id", first.alias("tool"), agents.tool_field(first, "name").alias("name"), agents.tool_field(first, "description").alias("description"), F.size("t").cast("long").alias("n"))


@query("t07_written_calls", f"select doc_id, md5('user:' || text || chr(1) || 'assistant:' || {HERMES_CALL} || chr(10) || {HERMES_CALL} || chr(1) || 'tool:' || source || chr(1) || 'assistant:' || {HERMES_CALL}) as messages, 0.5::double as loss_scale from documents where {FULL}")
def written_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = turns(("user", F.col("text")), ("tool_call", call()), ("tool_call", call()), ("tool", F.col("source")), ("tool_call", call()))
    scaled = F.transform(held, lambda m, i: m.withField("loss_scale", F.when(i == 2, F.lit(0.5))))
    out = docs(spark, sf_dir).select("doc_id", agents.written_calls(scaled, "hermes").alias("messages"))
    return out.select("doc_id", digest().alias("messages"), F.element_at("messages", 2)["loss_scale"].alias("loss_scale"))


@query("t08_folded_results", f"select doc_id, md5('user:' || text || '<tool_response>' || chr(10) || lang || chr(10) || '</tool_response>' || chr(10) || '<tool_response>' || chr(10) || source || chr(10) || '</tool_response>' || chr(1) || 'assistant:' || lang || chr(1) || 'tool:' || source) as messages from documents where {FULL}")
def folded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = turns(("user", F.col("text")), ("tool", F.col("lang")), ("tool", F.col("source")), ("assistant", F.col("lang")), ("tool", F.col("source")))
    return docs(spark, sf_dir).select("doc_id", agents.folded_results(held, "hermes").alias("messages")).select("doc_id", digest().alias("messages"))


@query("t12_placed_objects", f"select doc_id, md5(replace(replace(text, '<ref-object>', ''), '<bbox>', '') || lang || '[(' || (doc_id % 10)::varchar || ',2),(3,4)] and ' || source || '[(5,6)] <bbox>') as text from documents where {FULL}")
def placed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = F.replace(F.replace(F.col("text"), F.lit("<ref-object>"), F.lit("")), F.lit("<bbox>"), F.lit(""))
    text = F.concat(clean, F.lit("<ref-object><bbox> and <ref-object><bbox> <bbox>"))
    boxes = F.array(F.array((F.col("doc_id") % 10).cast("int"), F.lit(2), F.lit(3), F.lit(4)), F.array(F.lit(5), F.lit(6)))
    return docs(spark, sf_dir).select("doc_id", md5(agents.placed_objects(text, F.array("lang", "source"), boxes)).alias("text"))


EMPTY_THINK = "<think>\n\n</think>\n\n"


@query(
    "t15_plain_thinking",
    f"""select doc_id, md5('user:' || lang || chr(1) || 'assistant:' || text || chr(1) || 'user:' || source || chr(1) || 'assistant:' || case when doc_id % 2 = 0 then '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || text else '<think>' || text end) as messages
    from documents where {FULL} and not starts_with(text, '<think>')""",
)
def plain_thinking(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.concat(F.lit("<think>"), "text"))
    held = turns(("user", F.col("lang")), ("assistant", F.col("text")), ("user", F.col("source")), ("assistant", last))
    return docs(spark, sf_dir).where("not startswith(text, '<think>')").select("doc_id", agents.plain_thinking(held, EMPTY_THINK, last_only=True, after_user=True).alias("messages")).select("doc_id", digest().alias("messages"))


@query("t17_trained_ends", "select doc_id, '-100,' || (n_chars % 97)::varchar || ',7,' || case when doc_id % 2 = 0 then '8' else '-100' end || ',-100,5,-100,-100' as labels from documents where n_chars is not null and doc_id % 2 = 0 union all select doc_id, '-100,' || (n_chars % 97)::varchar || ',-100,-100,-100,5,-100,-100' from documents where n_chars is not null and doc_id % 2 = 1")
def trained_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trained token, the suffix 7, 8 (or 7, 9), a masked token, another trained one, and a tail that is no suffix."""
    own = (F.col("n_chars") % 97).cast("int")
    ids = F.array(F.lit(1), own, F.lit(7), F.when(F.col("doc_id") % 2 == 0, 8).otherwise(9), F.lit(3), F.lit(5), F.lit(7), F.lit(7))
    labels = F.array(F.lit(-100), own, F.lit(-100), F.lit(-100), F.lit(-100), F.lit(5), F.lit(-100), F.lit(-100))
    found = agents.trained_ends(ids, labels, [7, 8])
    return load(spark, sf_dir, "documents").where("n_chars is not null").select("doc_id", F.array_join(F.transform(found, lambda x: x.cast("string")), ",").alias("labels"))


FORMATS = {
    "react": ("'Action: ' || lang || chr(10) || 'Action Input: {\"n\":' || n_chars::varchar || '}' || chr(10) || 'Observation:'", "text || case when ends_with(text, chr(10)) then '' else chr(10) end || 'Observation:' || lang || chr(10)"),
    "hermes": (HERMES_CALL, "'<tool_response>' || chr(10) || text || chr(10) || '</tool_response>' || chr(10) || '<tool_response>' || chr(10) || lang || chr(10) || '</tool_response>'"),
    "hunyuan": (f"'<tool_calls>' || chr(10) || {HERMES_CALL} || chr(10) || '</tool_calls>'", "'<tool_responses><tool_response>' || text || '</tool_response>' || chr(10) || '<tool_response>' || lang || '</tool_response></tool_responses>'"),
    "mistral": (f"'[TOOL_CALLS][' || chr(10) || {CALL} || chr(10) || ']</s>'", None),
    "deepseek": ("'<｜tool▁calls▁begin｜><｜tool▁call▁begin｜>' || lang || '<｜tool▁sep｜>{\"n\":' || n_chars::varchar || '}<｜tool▁call▁end｜><｜tool▁calls▁end｜>'", "'<｜tool▁output▁begin｜>' || text || '<｜tool▁output▁end｜><｜tool▁output▁begin｜>' || lang || '<｜tool▁output▁end｜>'"),
    "kimi": ("'<|tool_calls_section_begin|><|tool_call_begin|>' || lang || '<|tool_call_argument_begin|>{\"n\":' || n_chars::varchar || '}<|tool_call_end|><|tool_calls_section_end|>'", "text || chr(10) || lang"),
    "qwen": ("'✿FUNCTION✿: ' || lang || chr(10) || '✿ARGS✿: {\"n\":' || n_chars::varchar || '}' || chr(10)", "'✿RESULT✿: ' || text || chr(10) || '✿RESULT✿: ' || lang || chr(10)"),
    "youtu": (f"'<tool_call>' || {CALL} || '</tool_call>'", "'<tool_response>' || text || '</tool_response>' || chr(10) || '<tool_response>' || lang || '</tool_response>'"),
}


def _format_query(name: str) -> None:
    calls, results = FORMATS[name]
    shown = f"md5({results})" if results else "null::varchar"

    @query(f"a_format_{name}", f"select doc_id, {calls} as call, {shown} as results from documents where {FULL}")
    def formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
        agent = agents.AGENTS[name]
        made = agent.calls(F.array(agents.call_parts(call())))
        both = md5(agent.results(F.array("text", "lang"))) if results else F.lit(None).cast("string")
        return docs(spark, sf_dir).select("doc_id", made.alias("call"), both.alias("results"))

    @query(f"a_read_{name}", f"select doc_id, lang as name, n_chars::varchar as n from documents where {FULL}")
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        """What the format's writer has written, read back by its reader."""
        reader = toolcalls.PARSERS["hermes" if name == "hunyuan" else name]
        found = docs(spark, sf_dir).select("doc_id", F.element_at(reader(agents.AGENTS[name].calls(F.array(agents.call_parts(call())))), 1).alias("c"))
        return found.select("doc_id", F.trim("c.name").alias("name"), F.get_json_object("c.arguments", "$.n").alias("n"))


for _name in FORMATS:
    _format_query(_name)


@query("a_read_tagged", f"select doc_id, lang as name, source as value from documents where {FULL}")
def read_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same call in each format of nested tags; all readers must agree."""
    pair = lambda before, between, after: F.concat(F.lit(before), F.col("lang"), F.lit(between), F.col("source"), F.lit(after))
    written = {
        "seed": pair("<seed:tool_call>\n<function=", ">\n<parameter=k>", "</parameter>\n</function>\n</seed:tool_call>"),
        "minimax": pair('<minimax:tool_call>\n<invoke name="', '">\n<parameter name="k">', "</parameter>\n</invoke>\n</minimax:tool_call>"),
        "qwen_coder": pair("<tool_call>\n<function=", ">\n<parameter=k>\n", "\n</parameter>\n</function>\n</tool_call>"),
        "glm": pair("<tool_call>", "\n<arg_key>k</arg_key>\n<arg_value>", "</arg_value>\n</tool_call>"),
        "hunyuan": pair("<tool_call>", '\n```json\n{"k": "', '"}\n```</tool_call>'),
    }
    found = F.array(*[F.element_at(toolcalls.PARSERS[k](v), 1) for k, v in written.items()])
    shown = F.array_distinct(F.transform(found, lambda c: F.struct(c["name"].alias("name"), F.get_json_object(c["arguments"], "$.k").alias("value"))))
    return docs(spark, sf_dir).select("doc_id", F.explode(shown).alias("c")).select("doc_id", "c.name", "c.value")


@query("a_tools_hermes", f"select doc_id, md5(source || chr(10) || chr(10) || '# Tools' || chr(10) || chr(10) || 'You may call one or more functions to assist with the user query.' || chr(10) || chr(10) || 'You are provided with function signatures within <tools></tools> XML tags:' || chr(10) || '<tools>' || chr(10) || '{{\"type\":\"function\",\"function\":' || {TOOL} || '}}' || chr(10) || '</tools>' || chr(10) || chr(10) || 'For each function call, return a json object with function name and arguments within <tool_call></tool_call> XML tags:' || chr(10) || '<tool_call>' || chr(10) || '{{\"name\": <function-name>, \"arguments\": <args-json-object>}}' || chr(10) || '</tool_call>') as system, '[AVAILABLE_TOOLS]{{\"type\":\"function\",\"function\":' || {TOOL} || '}}[/AVAILABLE_TOOLS]' as mistral from documents where {FULL}")
def tools_hermes(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = agents.listed_tools(tool())
    none = F.lit(None).cast("string")
    return docs(spark, sf_dir).select("doc_id", md5(agents.AGENTS["hermes"].tools(listed, F.col("source"))).alias("system"), agents.AGENTS["mistral"].tools(listed, none).alias("mistral"))


THINK = "'<think>' || chr(10) || '</think>' || chr(10)"


def quoted(text: str) -> str:
    return f"'{text}'"


def segments_sql(*parts: tuple[str, str]) -> str:
    return " || ';' || ".join(f"md5({text}) || '=' || '{weight}'" for text, weight in parts)


def shown_segments(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: F.concat(md5(s["content"]), F.lit("="), s["weight"].cast("string"))), ";")


PLAIN = f"{FULL} and not contains(text, '<') and not contains(text, 'Action') and not contains(text, 'Thought:') and not contains(text, 'Observation:') and not contains(text, 'Answer:') and text <> ''"


@query("w03_pattern_weights", f"select doc_id, {segments_sql(('text', '1.0'), (HERMES_CALL, '2.0'), ('lang', '1.0'))} as segments from documents where {PLAIN}")
def pattern_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("text", agents.AGENTS["hermes"].calls(F.array(agents.call_parts(call()))), "lang")
    return plain(spark, sf_dir).select("doc_id", shown_segments(weights.configured(text, "hermes")).alias("segments"))


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).where("not contains(text, '<') and not contains(text, 'Action') and not contains(text, 'Thought:') and not contains(text, 'Observation:') and not contains(text, 'Answer:') and text <> ''")


@query("w04_question_weights", f"select doc_id, case when doc_id % 2 = 0 then {segments_sql(('text || chr(65)', '3.0'))} else {segments_sql(('text || chr(65)', '1.0'))} end as segments from documents where {PLAIN} and not regexp_matches(text, '(Name:|Action:|ACTION:|Tool:|Command|Arguments:|action input|ACTION_INPUT:)')")
def question_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Well. What is the value of "), "lang")).otherwise(F.col("lang"))
    rows = plain(spark, sf_dir).where("not rlike(text, '(Name:|Action:|ACTION:|Tool:|Command|Arguments:|action input|ACTION_INPUT:)')")
    return rows.select("doc_id", shown_segments(weights.configured(F.concat("text", F.lit("A")), "agentflan", asked)).alias("segments"))


@query("w05_chained_weights", f"select doc_id, {segments_sql((THINK, '0.0'), (quoted('x'), '1.0'), (HERMES_CALL, '2.0'), ('lang', '1.0'))} as segments from documents where {PLAIN}")
def chained_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("<think>\n</think>\nx"), agents.AGENTS["hermes"].calls(F.array(agents.call_parts(call()))), "lang")
    return plain(spark, sf_dir).select("doc_id", shown_segments(weights.chained(text, ["hermes", "ignore_empty_think"])).alias("segments"))


@query("w07_shipped_weights", f"select doc_id, {segments_sql((quoted('Thought:'), '1.0'), ('text', '1.0'), (quoted('Action:'), '2.0'), ('lang', '2.0'), (quoted('Action Input:'), '2.0'), ('source', '2.0'), (quoted('Observation:'), '2.0'), ('text', '0.0'), (quoted('Next:'), '2.0'), ('lang', '2.0'))} as segments from documents where {PLAIN} and not contains(text, 'Next:')")
def shipped_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.lit("Thought:"), "text", F.lit("Action:"), "lang", F.lit("Action Input:"), "source", F.lit("Observation:"), "text", F.lit("Next:"), "lang"]
    return plain(spark, sf_dir).where("not contains(text, 'Next:')").select("doc_id", shown_segments(weights.configured(F.concat(*parts), "alpha_umi")).alias("segments"))


@query("w08_binary_specs", "select * from (values ('default', true), ('last_round+ignore_empty_think', true), ('react', false), ('all+hermes+ignore_think_prefix', false), ('agentflan', false)) t(spec, is_binary)")
def binary_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = ["default", "last_round+ignore_empty_think", "react", "all+hermes+ignore_think_prefix", "agentflan"]
    return spark.createDataFrame([(s, weights.is_binary(s)) for s in specs], "spec string, is_binary boolean")
