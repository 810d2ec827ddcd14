"""Queries of readers by format, registries, formats' names and small steps that other queries only contain."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import agents, extensions, metrics, providers, templates, toolcalls, weights
from parley.functions import messages as M
from parley.functions import sequences as S
from parley.functions.messages import MESSAGES, message
from parley.operators import advantages, encode, inference, normalize
from parley.plans.losses import r, rounded
from parley.plans.objects import as_json
from parley.plans.recipes import digest
from parley.plans.registry import load, query
from parley.plans.sources import QA, conversations, sharegpt
from parley.sources import readers
from parley.sources.scratch import folder
from parley.sources.spec import Dataset, Registry, Spec, Subset

FULL = "text is not null and lang is not null and source is not null and n_chars is not null"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where(FULL)


def turns(*pairs: tuple[str, Column]) -> Column:
    return F.array(*[message(F.lit(role), content) for role, content in pairs]).cast(MESSAGES)


def md5(c: Column) -> Column:
    return F.md5(c.cast("binary"))


# --- sources ---------------------------------------------------------------------------------

KINDS = ("csv", "jsonl", "parquet", "orc", "txt")


@query("s02_file_formats", f"select unnest(['csv', 'jsonl', 'orc', 'parquet']) as kind, doc_id, md5(text) as text from documents where {FULL} union all select 'txt', null, md5(lang) from documents where {FULL}")
def file_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table in each format by its extension; plain text has lines only."""
    base, rows, out = folder(spark, "formats"), docs(spark, sf_dir).select("doc_id", "text", "lang"), None
    for kind in KINDS:
        path = f"{base}/all.{kind}"
        if kind == "csv":
            rows.select("doc_id", F.base64(F.col("text").cast("binary")).alias("text")).write.option("header", True).csv(path)
        elif kind == "txt":
            rows.select("lang").write.text(path)
        else:
            rows.select("doc_id", "text").write.format({"jsonl": "json"}.get(kind, kind)).save(path)
        if kind == "jsonl":
            found = spark.read.schema("doc_id long, text string").json(path)
        else:
            found = readers.read_file(spark, path)
        if kind == "txt":
            found = found.select(F.lit(None).cast("long").alias("doc_id"), F.col("value").alias("text"))
        elif kind == "csv":
            found = found.select(F.col("doc_id").cast("long").alias("doc_id"), F.unbase64("text").cast("string").alias("text"))
        found = found.select(F.lit(kind).alias("kind"), "doc_id", md5(F.col("text")).alias("text"))
        out = found if out is None else out.union(found)
    return out


@query("s06_json_registry", "select * from (values ('one', '/base/rel.jsonl', 'Q=query', 'default'), ('org/two', null, '', 'a,b')) t(name, path, columns, subsets)")
def json_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of JSON text; paths relative to a file are resolved in the tests."""
    known = Registry()
    names = known.register_json(json.dumps([{"dataset_name": "one", "dataset_path": "/base/rel.jsonl", "columns": {"Q": "query"}}, {"ms_dataset_id": "org/two", "subsets": ["a", {"name": "b", "subset": "B"}]}]))
    found = [(n, (d := known.datasets[n]).path, ",".join(f"{k}={v}" for k, v in d.columns.items()), ",".join(s.name for s in d.subsets)) for n in names]
    return spark.createDataFrame(found, "name string, path string, columns string, subsets string")


@query("s07_registry_lookup", "select * from (values ('x', 1), ('hf::org/x', 1), ('/elsewhere/x', 1), ('y', 0)) t(asked, found)")
def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = Registry()
    own = Dataset("/data/x", {"hf": "org/x"})
    known.register("x", own)
    asked = ["x", "hf::org/x", "/elsewhere/x", "y"]
    return spark.createDataFrame([(a, int(known.resolve(Spec.parse(a, lambda p: False)) is own)) for a in asked], "asked string, found int")


@query("s08_subsets", "select * from (values ('', 'default'), ('all', 'default,b'), ('weak', 'weak'), ('b/new', 'b,new')) t(asked, subsets)")
def subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Dataset("x", subsets=[Subset(), Subset("b"), Subset("weak", is_weak=True)])
    asked = ["", "all", "weak", "b/new"]
    return spark.createDataFrame([(a, ",".join(s.name for s in d.select(tuple(x for x in a.split("/") if x)))) for a in asked], "asked string, subsets string")


@query("s09_jsonl_conversations", f"select {QA.format(q='text', a='lang')} as messages from documents where {FULL}")
def jsonl_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "jsonl") + ".jsonl"
    readers.write_jsonl(docs(spark, sf_dir).select(sharegpt("user", "assistant", "role", "content").alias("messages")), path)
    rows = spark.read.schema("messages array<struct<role string, content string>>").json(path)
    return conversations(normalize.auto_preprocess(rows))


@query("s12_cached_export", f"select doc_id, n_chars::bigint as length, 'train' as part from documents where {FULL} and doc_id % 10 > 0 union all select doc_id, n_chars, 'val' from documents where {FULL} and doc_id % 10 = 0")
def cached_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, rows = folder(spark, "export"), docs(spark, sf_dir).select("doc_id", "n_chars")
    for part, own in (("train", rows.where("doc_id % 10 > 0")), ("val", rows.where("doc_id % 10 = 0"))):
        readers.write_cached(own, f"{base}/{part}", F.array("n_chars"))
    read = lambda part: readers.read_cached(spark, f"{base}/{part}").select("doc_id", F.col("lengths")[0].cast("long").alias("length"), F.lit(part).alias("part"))
    return read("train").union(read("val"))


@query("d14_routing_tag", f"select count(*)::bigint as n, 'tagged' as dataset from documents where {FULL}")
def routing_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, known = f"{folder(spark, 'tag')}.parquet", Registry()
    docs(spark, sf_dir).select(F.col("text").alias("query"), F.col("lang").alias("response")).write.parquet(path)
    known.register("tagged", Dataset(path))
    return readers.load_dataset(spark, "tagged", known, tag=True).groupBy("dataset").agg(F.count("*").alias("n"))


# --- normalization ---------------------------------------------------------------------------


@query("n16_message_keys", f"select doc_id, {QA.format(q='text', a='lang')} as messages from documents where {FULL}")
def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'from' and 'content', a mix of both layouts' keys."""
    rows = docs(spark, sf_dir).select("doc_id", sharegpt("user", "assistant", "from", "content").alias("m"))
    return rows.select("doc_id", normalize.standard_messages("m", rows.schema["m"].dataType).alias("messages")).select("doc_id", digest().alias("messages"))


@query("n21_detected_format", f"select doc_id, case doc_id % 4 when 0 then 'openai' when 1 then 'anthropic' when 2 then 'anthropic' else 'native' end as format from documents where {FULL}")
def detected_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = as_json(F.col("text"))
    contents = [F.concat(F.lit('"content":'), text, F.lit(',"tool_calls":[{"name":"f"}]')), F.concat(F.lit('"content":[{"type":"tool_use","name":"f","input":{}},{"type":"text","text":'), text, F.lit("}]")), F.concat(F.lit('"content":[{"type":"image","source":{"type":"url","url":"u"}},{"type":"text","text":'), text, F.lit("}]")), F.concat(F.lit('"content":'), text)]
    pick = F.get(F.array(*contents), (F.col("doc_id") % 4).cast("int"))
    return docs(spark, sf_dir).select("doc_id", providers.normalized(F.concat(F.lit('[{"role":"assistant",'), pick, F.lit("}]")))["format"].alias("format"))


@query("n24_auto_layouts", f"select 'messages' as layout, count(*)::bigint as n from documents where {FULL} union all select 'alpaca', count(*) from documents where {FULL} union all select 'response', count(*) from documents where {FULL}")
def auto_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each layout is told by its columns, and every row becomes a conversation of two turns."""
    rows = docs(spark, sf_dir)
    layouts = {"messages": rows.select(sharegpt("human", "gpt").alias("conversations")), "alpaca": rows.select(F.col("text").alias("instruction"), F.lit("").alias("input"), F.col("lang").alias("output")), "response": rows.select(F.col("text").alias("problem"), F.col("lang").alias("answer"))}
    out = None
    for name, df in layouts.items():
        n = extensions.apply_preprocessor(df, "auto").where("size(messages) = 2").agg(F.count("*").alias("n")).select(F.lit(name).alias("layout"), "n")
        out = n if out is None else out.union(n)
    return out


@query("n25_forced_format", f"select doc_id, 'anthropic' as format, md5('user:' || text) as messages from documents where {FULL}")
def forced_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.concat(F.lit('[{"role":"user","content":'), as_json(F.col("text")), F.lit("}]"))
    return docs(spark, sf_dir).select("doc_id", providers.normalized(whole, "anthropic").alias("n")).select("doc_id", "n.format", digest("n.messages").alias("messages"))


# --- templates -------------------------------------------------------------------------------


@query("t01_stop_words", f"select doc_id, md5('<|im_start|>user' || chr(10) || lang || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || text || '<|im_end|>' || case when doc_id % 2 = 0 then chr(10) else '' end) as text from documents where {FULL} and not ends_with(text, '<|im_end|>')")
def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suffix only where the answer does not end with a stop word already."""
    answer = F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit("<|im_end|>")))
    rows = docs(spark, sf_dir).where("not endswith(text, '<|im_end|>')")
    return rows.select("doc_id", md5(encode.by_rounds(turns(("user", F.col("lang")), ("assistant", answer)), encode.ROUNDS["chatml"])).alias("text"))


@query("t03_filled_marks", f"select doc_id, md5('1:' || text || ':2:{{{{QUERY}}}}') as text from documents where {FULL}")
def filled_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value that looks like a mark is not filled in again."""
    made = encode.filled("{{ROUND0}}:{{QUERY}}:{{ROUND1}}:{{SYSTEM}}", {"ROUND0": F.lit("1"), "ROUND1": F.lit("2"), "QUERY": F.col("text"), "SYSTEM": F.lit("{{QUERY}}")})
    return docs(spark, sf_dir).select("doc_id", md5(made).alias("text"))


@query("t10_image_tags", f"select doc_id, md5(text || '<image> and <image>') as text, lang || '|' || source as images from documents where {FULL} and not contains(text, '<img>')")
def image_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, images = normalize.image_tags(F.concat("text", F.lit("<img>"), "lang", F.lit("</img> and <img>"), "source", F.lit("</img>")))
    return docs(spark, sf_dir).where("not contains(text, '<img>')").select("doc_id", md5(text).alias("text"), F.array_join(images, "|").alias("images"))


@query("t13_split_parts", f"select doc_id, '|Action:|Thought:' as keys, md5(text || chr(1) || lang || chr(1) || source) as contents from documents where {FULL} and text <> '' and not contains(text, 'Action:') and not contains(text, 'Thought:')")
def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).where("text <> '' and not contains(text, 'Action:') and not contains(text, 'Thought:')")
    found = rows.select("doc_id", weights.split_by(F.concat("text", F.lit("Action:"), "lang", F.lit("Thought:"), "source"), ["Thought:", "Action:"]).alias("p"))
    return found.select("doc_id", F.array_join(F.transform("p", lambda p: p["key"]), "|").alias("keys"), md5(F.array_join(F.transform("p", lambda p: p["content"]), "\x01")).alias("contents"))


@query("t18_first_masked", f"select doc_id, '-100,' || doc_id::varchar || ',-100' as labels from documents where {FULL}")
def first_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = S.labels(F.array(F.lit(5).cast("long"), F.col("doc_id"), F.lit(7).cast("long")), F.array(F.lit(1.0), F.lit(1.0), F.lit(0.0)))
    return docs(spark, sf_dir).select("doc_id", F.array_join(F.transform(made, lambda x: x.cast("string")), ",").alias("labels"))


@query("t22_lengths", f"select doc_id, greatest(doc_id % 5, 3)::integer as length, greatest(doc_id % 5, 3)::integer as kept from documents where {FULL}")
def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longer of two arrays, by the expression and by the step that adds a column (T25)."""
    rows = docs(spark, sf_dir).select("doc_id", F.array_repeat(F.lit(1), (F.col("doc_id") % 5).cast("int")).alias("a"), F.array_repeat(F.lit(1), 3).alias("b"))
    return encode.with_length(rows, "a", "b").select("doc_id", S.length(F.col("a"), F.col("b"), F.lit(None).cast("array<int>")).alias("length"), F.col("length").alias("kept"))


@query("t25_encoded_lengths", f"select doc_id, (len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) + 1)::integer as length from documents where {FULL}")
def encoded_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", turns(("user", F.col("lang")), ("assistant", F.col("text"))).alias("messages"))
    return encode.with_length(encode.encode(rows, "causal_lm", encode.word_ids, "doc_id"), "input_ids", "labels").select("doc_id", "length")


@query("t30_template_names", "select unnest(['chatml', 'llama3', 'plain']) as name")
def template_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in templates.TEMPLATES], "name string")


# --- agents ----------------------------------------------------------------------------------


@query("a03_hunyuan", f"select doc_id, lang as name, source as value from documents where {FULL}")
def hunyuan(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("<tool_calls>\n<tool_call>"), "lang", F.lit('\n```json\n{"k": "'), "source", F.lit('"}\n```</tool_call>\n</tool_calls>'))
    return read_call(spark, sf_dir, text, "hunyuan_hermes")


def read_call(spark: SparkSession, sf_dir: str, text: Column, agent: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", F.explode(toolcalls.PARSERS[agent](text)).alias("c"))
    return rows.select("doc_id", "c.name", F.get_json_object("c.arguments", "$.k").alias("value"))


@query("a04_qwen", f"select doc_id, lang as name, source as value from documents where {FULL}")
def qwen(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("✿FUNCTION✿: "), "lang", F.lit('\n✿ARGS✿: {"k": "'), "source", F.lit('"}\n✿RESULT✿: '))
    return read_call(spark, sf_dir, text, "qwen_en")


@query("a05_nested_tags", f"select doc_id, lang as name, source as value from documents where {FULL}")
def nested_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("<tool_call>\n<function="), "lang", F.lit(">\n<parameter=k>\n"), "source", F.lit("\n</parameter>\n</function>\n</tool_call>"))
    return read_call(spark, sf_dir, text, "qwen3_coder")


@query("a08_marked_calls", f"select doc_id, lang as name, source as value, unnest(['deepseek_v3_1', 'kimi_k25', 'minimax_m2', 'mistral', 'seed_oss', 'youtu']) as agent from documents where {FULL}")
def marked_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same call in six formats."""
    made = lambda a, b, c: F.concat(F.lit(a), F.col("lang"), F.lit(b), F.col("source"), F.lit(c))
    texts = {
        "deepseek_v3_1": made("<｜tool▁calls▁begin｜><｜tool▁call▁begin｜>", '<｜tool▁sep｜>{"k": "', '"}<｜tool▁call▁end｜><｜tool▁calls▁end｜>'),
        "kimi_k25": made("<|tool_calls_section_begin|><|tool_call_begin|>", '<|tool_call_argument_begin|>{"k": "', '"}<|tool_call_end|><|tool_calls_section_end|>'),
        "minimax_m2": made('<minimax:tool_call>\n<invoke name="', '">\n<parameter name="k">', "</parameter>\n</invoke>\n</minimax:tool_call>"),
        "mistral": made('[TOOL_CALLS][\n{"name": "', '", "arguments": {"k": "', '"}}\n]</s>'),
        "seed_oss": made("<seed:tool_call>\n<function=", ">\n<parameter=k>", "</parameter>\n</function>\n</seed:tool_call>"),
        "youtu": made('<tool_call>{"name": "', '", "arguments": {"k": "', '"}}</tool_call>'),
    }
    out = None
    for agent, text in texts.items():
        rows = read_call(spark, sf_dir, text, agent).withColumn("agent", F.lit(agent))
        out = rows if out is None else out.union(rows)
    return out


@query("a09_agent_names", "select unnest(['react', 'hermes', 'hunyuan', 'mistral', 'deepseek', 'kimi', 'qwen', 'youtu']) as name, true as reads, true as writes")
def agent_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats that have both a reader and a writer under one name."""
    names = ["react", "hermes", "hunyuan", "mistral", "deepseek", "kimi", "qwen", "youtu"]
    return spark.createDataFrame([(n, n in toolcalls.PARSERS, n in agents.AGENTS) for n in names], "name string, reads boolean, writes boolean")


# --- weights, packing, rewards, metrics ------------------------------------------------------


@query("w02_last_round", "with c as (select conv_id, row_number() over (partition by conv_id order by turn, role, text) - 1 i, role from conversations where role is not null and text is not null) select conv_id, coalesce(max(i) filter (where role in ('user', 'tool')), -1)::integer as last from c group by conv_id")
def last_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.plans.recipes import conversations as whole

    return whole(spark, sf_dir).select("conv_id", M.last_user_round(F.col("messages")).alias("last"))


@query("w06_weight_specs", "select * from (values ('default', 'default', 'base'), ('last_round+qwen', 'last_round', 'qwen'), ('hermes+ignore_empty_think', 'default', 'hermes,ignore_empty_think')) t(spec, strategy, names)")
def weight_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = ["default", "last_round+qwen", "hermes+ignore_empty_think"]
    return spark.createDataFrame([(s, weights.parsed_spec(s)[0], ",".join(weights.parsed_spec(s)[1])) for s in specs], "spec string, strategy string, names string")


@query("r06q_words_score_nothing", f"select doc_id, 0.0::double as reward from documents where {FULL}")
def words_score_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that are no JSON objects never earn the reward, however alike."""
    call = F.concat(F.lit("Action: "), "lang", F.lit("\nAction Input: "), "source")
    return docs(spark, sf_dir).select("doc_id", providers.action_reward(call, call).alias("reward"))


@query("r09_reward_names", "select unnest(['format', 'react_format', 'repetition']) as name")
def reward_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["format", "react_format", "repetition"]
    return spark.createDataFrame([(n,) for n in names if callable(extensions.find("reward", n))], "name string")


@query("g11_length_stats", f"select {r('avg(n_chars)', 'mean')}, {r('stddev_pop(n_chars)', 'std')}, min(n_chars)::bigint as least, max(n_chars)::bigint as most, count(*)::bigint as size from documents where {FULL}")
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).withColumn("lengths", F.array("n_chars", F.lit(0)))
    return rounded(rows.withColumn("l", F.array_max("lengths")).agg(F.avg("l").alias("mean"), F.stddev_pop("l").alias("std"), F.min("l").cast("long").alias("least"), F.max("l").cast("long").alias("most"), F.count("l").alias("size")), "least", "most", "size")


@query("g15_nan_std", "select user_id, case when count(value) > 1 then round(stddev_samp(value), 7) + 0.0 else 'nan'::double end as std from events group by user_id")
def nan_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(load(spark, sf_dir, "events").groupBy("user_id").agg(metrics.METRICS["nan_std"]("value").alias("std")), "user_id")


@query("v01_total_reward", f"select doc_id, {r('2 * (doc_id % 3) + case when doc_id % 4 = 0 then 0 else 0.5 * (doc_id % 4) end - 0.1 * (doc_id % 7)', 'reward')} from documents")
def total_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing reward counts as none, and the divergence is taken off."""
    d = F.col("doc_id")
    rows = load(spark, sf_dir, "documents").select("doc_id", (d % 3).cast("double").alias("a"), F.when(d % 4 != 0, (d % 4).cast("double")).alias("b"), (d % 7).cast("double").alias("kl"))
    return rounded(rows.select("doc_id", advantages.total_reward({"a": 2.0, "b": 0.5}, "kl", 0.1).alias("reward")), "doc_id")


@query("i02_cache_choices", "select user_id, count(*)::integer as n, string_agg(event_type, '|' order by event_id) as choices from events group by user_id")
def cache_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inference.cached(load(spark, sf_dir, "events"), "user_id", "event_type", "event_id")
    return found.select("user_id", F.size("choices").alias("n"), F.array_join("choices", "|").alias("choices"))
