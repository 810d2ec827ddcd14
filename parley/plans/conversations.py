"""Queries over the conversations table: validation, rounds, rendering, weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import messages as M
from parley.functions import templates, weights
from parley.plans.registry import load, query


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: ``conv_id, messages``."""
    return load(spark, sf_dir, "conversations").groupBy("conv_id").agg(M.of_turns().alias("messages"))


@query(
    "n06_valid_conversations",
    """select conv_id, count(*)::bigint as n_turns,
    bool_and(role in ('system','user','tool_call','tool_response','tool','assistant') and text is not null) as is_valid from conversations group by conv_id""",
)
def valid_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = conversations(spark, sf_dir)
    return df.select("conv_id", F.size("messages").cast("long").alias("n_turns"), M.is_valid(F.col("messages")).alias("is_valid"))


NUMBERED = "with c as (select *, row_number() over (partition by conv_id order by turn) - 1 i, count(*) over (partition by conv_id) n from conversations) "


@query(
    "n33_last_user_round",
    NUMBERED + """select conv_id, coalesce(max(i) filter (where role in ('user','tool')), -1)::bigint as last_user_turn,
    (max(n) - 1 - coalesce(max(i) filter (where role in ('user','tool')), -1))::bigint as later_turns from c group by conv_id""",
)
def last_user_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = M.last_user_round(F.col("messages"))
    return conversations(spark, sf_dir).select("conv_id", last.cast("long").alias("last_user_turn"), (F.size("messages") - 1 - last).cast("long").alias("later_turns"))


@query(
    "n34_remove_response",
    NUMBERED + """select conv_id, max(text) filter (where i = n - 1 and role = 'assistant') as label,
    (max(n) - count(*) filter (where i = n - 1 and role = 'assistant'))::bigint as left_turns from c group by conv_id""",
)
def remove_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("messages")
    return conversations(spark, sf_dir).select("conv_id", M.response(m).alias("label"), F.size(M.without_response(m)).cast("long").alias("left_turns"))


@query(
    "n13_history_pairs",
    """with c as (select conv_id, text, row_number() over (partition by conv_id order by turn) - 1 i,
    lead(text) over (partition by conv_id order by turn) nxt from conversations where role <> 'system')
    select conv_id, (i // 2)::bigint as round, text as query, nxt as response from c where i % 2 = 0""",
)
def history_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir).select("conv_id", F.posexplode(M.history_pairs(F.col("messages"))).alias("round", "pair"))
    return rows.select("conv_id", F.col("round").cast("long").alias("round"), "pair.query", "pair.response")


@query(
    "n12_round_trip_history",
    "select conv_id, count(*)::bigint as n_messages, sum(length(text))::bigint as chars from conversations where role <> 'system' group by conv_id",
)
def round_trip_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = conversations(spark, sf_dir).select("conv_id", M.from_history(M.history_pairs(F.col("messages"))).alias("m"))
    chars = F.aggregate("m", F.lit(0).cast("long"), lambda acc, x: acc + F.length(x["content"]))
    return again.select("conv_id", F.size("m").cast("long").alias("n_messages"), chars.alias("chars"))


@query(
    "n39_messages_to_query",
    """select conv_id, string_agg(upper(role[1]) || role[2:] || ': ' || text, chr(10) order by turn) as query
    from conversations where role in ('user','assistant','system') and length(text) > 0 group by conv_id""",
)
def messages_to_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select("conv_id", M.as_query(F.col("messages")).alias("query"))


@query(
    "n17_standard_roles",
    """select role as found, case when role in ('user') then 'user' else role end as role, count(*)::bigint as n from conversations group by 1, 2""",
)
def standard_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table's roles under other public names, mapped back
    other = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    df = load(spark, sf_dir, "conversations").select(F.col("role").alias("found"), M.standard_role(other).alias("role"))
    return df.groupBy("found", "role").agg(F.count("*").alias("n"))


@query(
    "n32_rejected_messages",
    NUMBERED + """, l as (select conv_id, coalesce(max(i) filter (where role in ('user','tool')), -1) l, max(n) n from c group by conv_id)
    select conv_id, (l + 2)::bigint as n_rejected, 'no' as last_content from l""",
)
def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = M.chosen_and_rejected(F.col("messages"), F.lit("no"))
    return conversations(spark, sf_dir).select("conv_id", F.size(r).cast("long").alias("n_rejected"), F.element_at(r, -1)["content"].alias("last_content"))


RENDERED = """case role when 'system' then '<|im_start|>system' || chr(10) || text || '<|im_end|>' || chr(10)
  when 'user' then '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
  else text || '<|im_end|>' || chr(10) end"""


@query(
    "t02_chatml_render",
    f"select conv_id, string_agg({RENDERED}, '' order by turn) as rendered, count(*)::bigint as n_turns from conversations group by conv_id",
)
def chatml_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: conversations gathered, validated, rendered for training."""
    df = conversations(spark, sf_dir).where(M.is_valid(F.col("messages")))
    return df.select("conv_id", templates.render(F.col("messages")).alias("rendered"), F.size("messages").cast("long").alias("n_turns"))


@query(
    "t02_prompt_render",
    NUMBERED + f"select conv_id, coalesce(string_agg({RENDERED}, '' order by turn) filter (where not (i = n - 1 and role = 'assistant')), '') as prompt from c group by conv_id",
)
def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select("conv_id", templates.render(F.col("messages"), train=False).alias("prompt"))


@query(
    "t02_llama3_render",
    """select conv_id, '<|begin_of_text|>' || string_agg(case role when 'system' then '<|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|>'
    when 'user' then '<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || text || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)
    else text || '<|eot_id|>' end, '' order by turn) as rendered from conversations group by conv_id""",
)
def llama3_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(spark, sf_dir).select("conv_id", templates.render(F.col("messages"), templates.LLAMA3).alias("rendered"))


@query(
    "t04_merge_same_role",
    """with c as (select conv_id, turn, case when turn % 3 = 2 then 'user' else role end r, text from conversations where role <> 'system'),
    s as (select *, case when lag(r) over (partition by conv_id order by turn) = r then 0 else 1 end b from c),
    g as (select *, sum(b) over (partition by conv_id order by turn) island from s)
    select conv_id, island::bigint as island, min(r) as role, string_agg(text, '' order by turn) as content from g group by conv_id, island""",
)
def merge_same_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").where("role <> 'system'")
    rows = rows.withColumn("role", F.when(F.col("turn") % 3 == 2, "user").otherwise(F.col("role")))
    merged = rows.groupBy("conv_id").agg(M.merged(M.of_turns()).alias("m"))
    out = merged.select("conv_id", F.posexplode("m").alias("i", "x"))
    return out.select("conv_id", (F.col("i") + 1).cast("long").alias("island"), "x.role", "x.content")


@query(
    "t14_strip_thinking",
    """with c as (select *, row_number() over (partition by conv_id order by turn) - 1 i from conversations),
    l as (select *, max(i) filter (where role in ('user','tool')) over (partition by conv_id) l from c)
    select conv_id, string_agg(case when role = 'assistant' and not i < coalesce(l, -1) then '<think>x</think> ' || text when role = 'assistant' then trim(text) else text end, '|' order by turn) as contents
    from l group by conv_id""",
)
def strip_thinking(spark: SparkSession, sf_dir: str) -> DataFrame:
    thought = F.transform("messages", lambda m: F.when(m["role"] == "assistant", m.withField("content", F.concat(F.lit("<think>x</think> "), m["content"]))).otherwise(m))
    df = conversations(spark, sf_dir).withColumn("messages", thought)
    return df.select("conv_id", F.array_join(F.transform(templates.strip_thinking(F.col("messages")), lambda m: m["content"]), "|").alias("contents"))


@query(
    "w01_loss_weights",
    NUMBERED + """, l as (select *, coalesce(max(i) filter (where role in ('user','tool')) over (partition by conv_id), -1) l from c)
    select conv_id, turn, (role in ('assistant','tool_call'))::int::double as w_default,
    (role in ('assistant','tool_call') and i >= l)::int::double as w_last_round, 1.0::double as w_all from l""",
)
def loss_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(M.of_turns().alias("messages"), F.sort_array(F.collect_list("turn")).alias("turns"))
    cols = [weights.conversation_weights(F.col("messages"), s).alias(f"w_{s}") for s in weights.STRATEGIES]
    rows = df.select("conv_id", F.explode(F.arrays_zip("turns", *cols)).alias("x"))
    return rows.select("conv_id", F.col("x.turns").alias("turn"), "x.w_default", "x.w_last_round", "x.w_all")


@query(
    "w03_segment_weights",
    """select conv_id, turn, (2.0 * 8 + 0.5 * length(text) + length(role))::double as weighed, (8 + length(text) + length(role))::bigint as chars from conversations""",
)
def segment_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "conversations")
    parts = weights.segment_weights(F.concat("role", F.lit("<answer>"), "text"), {"<answer>": (2.0, 0.5)})
    weighed = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["weight"] * F.length(p["content"]))
    chars = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + F.length(p["content"]))
    return df.withColumn("parts", parts).select("conv_id", "turn", weighed.alias("weighed"), chars.alias("chars"))


@query(
    "i03_cache_join",
    """with k as (select conv_id, turn, md5(role || ':' || text) key from conversations where role = 'user'),
    cache as (select key, count(*) n from k where turn % 2 = 0 group by key)
    select k.conv_id, k.turn, coalesce(cache.n, 0)::bigint as choices, cache.key is not null and cache.n = 1 as hit from k left join cache using (key)""",
)
def cache_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = load(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", F.md5(F.concat("role", F.lit(":"), "text").cast("binary")).alias("key"))
    cache = asked.where("turn % 2 = 0").groupBy("key").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return asked.join(cache, "key", "left").select("conv_id", "turn", n.alias("choices"), (n == 1).alias("hit"))


@query(
    "e21_split_dialog",
    """with d as (select conv_id, string_agg(case role when 'user' then chr(10) || chr(10) || 'Human: ' || text else chr(10) || chr(10) || 'Assistant: ' || text end, '' order by turn) s
    from conversations where role <> 'system' group by conv_id)
    select conv_id, (len(regexp_split_to_array(s, '\\n\\n(Human|Assistant):')) - 1)::bigint as n_parts, trim(regexp_split_to_array(s, '\\n\\n(Human|Assistant):')[2]) as first from d""",
)
def split_dialog(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.struct("turn", F.concat(F.when(F.col("role") == "user", "\n\nHuman: ").otherwise("\n\nAssistant: "), "text").alias("s"))
    dialog = F.array_join(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["s"]), "")
    df = load(spark, sf_dir, "conversations").where("role <> 'system'").groupBy("conv_id").agg(F.split(dialog, r"\n\n(Human|Assistant):").alias("parts"))
    return df.select("conv_id", (F.size("parts") - 1).cast("long").alias("n_parts"), F.trim(F.get("parts", F.lit(1))).alias("first"))
