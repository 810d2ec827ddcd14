"""Queries of rewards, tool calls, advantages, selection and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.functions import metrics, rewards, toolcalls
from parley.operators import advantages
from parley.plans.registry import load, query


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents dressed up as completions: some in the asked-for format, some not."""
    return load(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<think>"), "text", F.lit("</think>\n<answer>a</answer>")))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("x<think>"), "text", F.lit("</think><answer>a</answer>")))
        .otherwise(F.concat(F.lit("<think>t</think>\nAction: go\nAction Input: "), "text"))
        .alias("completion"),
    )


COMPLETIONS = """with c as (select doc_id, case doc_id % 3 when 0 then '<think>' || text || '</think>' || chr(10) || '<answer>a</answer>'
when 1 then 'x<think>' || text || '</think><answer>a</answer>' else '<think>t</think>' || chr(10) || 'Action: go' || chr(10) || 'Action Input: ' || text end completion from documents) """


@query("r01_format", COMPLETIONS + "select doc_id, regexp_matches(completion, '(?s)\\A<think>.*?</think>\\s*<answer>.*?</answer>\\z')::int::double as reward from c")
def format_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).select("doc_id", rewards.format_reward(F.col("completion")).alias("reward"))


@query("r02_react_format", COMPLETIONS + "select doc_id, regexp_matches(completion, '(?s)\\A<think>.*?</think>\\s*Action:.*?Action Input:')::int::double as reward from c")
def react_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completions(spark, sf_dir).select("doc_id", rewards.react_format_reward(F.col("completion")).alias("reward"))


@query(
    "r03_cosine",
    """select doc_id, round(case when quality = 1 then 0.5 + 0.25 * (1 + cos(pi() * least(n_chars, 4096) / 4096.0::double))
    else -0.5 + -0.25 * (1 + cos(pi() * least(n_chars, 4096) / 4096.0::double)) end, 9) as reward from documents join labels using (doc_id)""",
)
def cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "documents").select("doc_id", "n_chars").join(load(spark, sf_dir, "labels"), "doc_id")
    return df.select("doc_id", F.round(rewards.cosine_reward(F.col("n_chars"), F.col("quality") == 1, 4096), 9).alias("reward"))


@query(
    "r04_repetition",
    """with w as (select doc_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') w from documents),
    g as (select doc_id, len(w) n, case when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) else [] end g from w)
    select doc_id, round(case when n >= 3 then -(1.0::double - len(list_distinct(g)) / len(g)::double) else 0.0 end, 9) + 0.0 as reward from g""",
)
def repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", (F.round(rewards.repetition_reward(F.col("text")), 9) + F.lit(0.0)).alias("reward"))


@query("r05_overlong", "select doc_id, round(least(-(n_chars - 3072) / 1024.0::double, 0.0), 9) as reward from documents")
def overlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", F.round(rewards.overlong_reward(F.col("n_chars"), 4096, 1024), 9).alias("reward"))


@query(
    "r07_boxed_math",
    "select doc_id, case when doc_id % 7 = doc_id % 5 then 1.0 else 0.0 end::double as reward from documents",
)
def boxed_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxed = lambda n: F.concat(F.lit("so \\boxed{ "), (F.col("doc_id") % n).cast("string"), F.lit("}"))
    return load(spark, sf_dir, "documents").select("doc_id", rewards.math_reward(boxed(7), boxed(5)).alias("reward"))


@query(
    "r12_judged",
    "select lang, round(avg(case when doc_id % 4 = 3 then null else (doc_id % 4) / 4.0::double end), 9) as reward from documents group by lang",
)
def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.when(F.col("doc_id") % 4 == 3, "no verdict").otherwise(F.concat(F.lit("Fine. Reward: "), (F.col("doc_id") % 4 / 4).cast("string")))
    return load(spark, sf_dir, "documents").select("lang", rewards.judged_reward(answer).alias("r")).groupBy("lang").agg(F.round(F.avg("r"), 9).alias("reward"))


@query(
    "r13_reward_table",
    COMPLETIONS + """select doc_id, regexp_matches(completion, '(?s)\\A<think>.*?</think>\\s*<answer>.*?</answer>\\z')::int::double as format,
    regexp_matches(completion, '(?s)\\A<think>.*?</think>\\s*Action:.*?Action Input:')::int::double as react_format from c""",
)
def reward_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [rewards.REWARDS[n](F.col("completion")).alias(n) for n in ("format", "react_format")]
    return completions(spark, sf_dir).select("doc_id", *cols)


@query(
    "a02_hermes_calls",
    "select event_id, event_type as name, user_id::varchar as arguments from events where event_id % 2 = 0",
)
def hermes_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.to_json(F.struct(F.col("event_type").alias("name"), F.col("user_id").alias("arguments")))
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("x <tool_call>\n"), call, F.lit("\n</tool_call>"))).otherwise("none")
    calls = load(spark, sf_dir, "events").select("event_id", F.explode(toolcalls.hermes_calls(text)).alias("c"))
    return calls.select("event_id", "c.name", "c.arguments")


@query("a01_react_calls", "select event_id, event_type as name, value::varchar as arguments from (select event_id, event_type, event_id * 3 as value from events)")
def react_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Thought: t\nAction: "), "event_type", F.lit("\nAction Input: "), (F.col("event_id") * 3).cast("string"), F.lit("\nObservation: o"))
    calls = load(spark, sf_dir, "events").select("event_id", F.explode(toolcalls.react_calls(text)).alias("c"))
    return calls.select("event_id", "c.name", "c.arguments")


@query("a06_glm_calls", "select event_id, event_type as name, '{\"user\":\"' || user_id::varchar || '\"}' as arguments from events")
def glm_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("<tool_call>"), "event_type", F.lit("\n<arg_key>user</arg_key>\n<arg_value>"), F.col("user_id").cast("string"), F.lit("</arg_value></tool_call>"))
    calls = load(spark, sf_dir, "events").select("event_id", F.explode(toolcalls.glm_calls(text)).alias("c"))
    return calls.select("event_id", "c.name", "c.arguments")


@query("a07_llama_calls", "select event_id, event_type as name, '{\"user\":' || user_id::varchar || '}' as arguments from events")
def llama_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('{"name": "'), "event_type", F.lit('", "parameters": {"user": '), F.col("user_id").cast("string"), F.lit("}}<|eom_id|>"))
    calls = load(spark, sf_dir, "events").select("event_id", F.explode(toolcalls.llama_calls(text)).alias("c"))
    return calls.select("event_id", "c.name", "c.arguments")


# --- advantages ------------------------------------------------------------------------------


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as scored completions of their orders."""
    line = load(spark, sf_dir, "lineitem")
    return line.select(
        F.col("l_orderkey").alias("prompt"), F.col("l_linenumber").cast("long").alias("line"), F.col("l_discount").alias("r1"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_tax")).alias("r2")
    ).withColumn("reward", advantages.total_reward({"r1": 1.0, "r2": 0.5}))


SCORED = """with s as (select l_orderkey prompt, l_linenumber::bigint line, l_discount r1, case when l_linenumber % 4 <> 0 then l_tax end r2 from lineitem),
t as (select *, coalesce(r1, 0) + coalesce(r2, 0) * 0.5 reward from s),
g as (select *, avg(reward) over w mean, coalesce(stddev_samp(reward) over w, 0) std, count(*) over w n from t window w as (partition by prompt)) """


def keyed(df: DataFrame, value: str = "advantage") -> DataFrame:
    return df.select("prompt", "line", (F.round(value, 6) + F.lit(0.0)).alias("advantage"))


@query("v02_grpo", SCORED + "select prompt, line, round((reward - mean) / (std + 1e-4), 6) + 0.0 as advantage from g")
def grpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(scored(spark, sf_dir).withColumn("advantage", advantages.advantage("reward", "prompt")))


@query("v03_rloo", SCORED + "select prompt, line, round(case when n > 1 then (reward - mean) * n / (n - 1) else reward - mean end, 6) + 0.0 as advantage from g")
def rloo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(scored(spark, sf_dir).withColumn("advantage", advantages.advantage("reward", "prompt", "rloo", "none")))


@query("v04_batch_scaled", SCORED + "select prompt, line, round((reward - mean) / ((select stddev_samp(reward) from t) + 1e-4), 6) + 0.0 as advantage from g")
def batch_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(advantages.batch_scaled(scored(spark, sf_dir), "reward", "prompt"))


@query("v05_reinforce_pp", SCORED + "select prompt, line, round((reward - mean) / ((select stddev_samp(reward - mean) from g) + 1e-4), 6) + 0.0 as advantage from g")
def reinforce_pp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(advantages.reinforce_plus_plus(scored(spark, sf_dir), "reward", "prompt"))


@query(
    "v06_gdpo",
    SCORED + """, p as (select prompt, line, coalesce((r1 - avg(r1) over w) / (coalesce(stddev_samp(r1) over w, 0) + 1e-8), 0)
    + 0.5 * coalesce((r2 - avg(r2) over w) / (coalesce(stddev_samp(r2) over w, 0) + 1e-8), 0) a from s window w as (partition by prompt))
    select prompt, line, round((a - (select avg(a) from p)) / ((select stddev_samp(a) from p) + 1e-8), 5) + 0.0 as advantage from p""",
)
def gdpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = advantages.decoupled(scored(spark, sf_dir), {"r1": 1.0, "r2": 0.5}, "prompt")
    return df.select("prompt", "line", (F.round("advantage", 5) + F.lit(0.0)).alias("advantage"))


@query("v08_zero_variance", SCORED + "select prompt, line from g where prompt in (select prompt from t group by prompt having max(reward) > min(reward))")
def zero_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advantages.informative(scored(spark, sf_dir), "reward", "prompt").select("prompt", "line")


@query(
    "g13_reward_metrics",
    SCORED + """, m as (select prompt, avg(reward) m, coalesce(stddev_samp(reward), 0) s, min(reward) = max(reward) flat from t group by prompt)
    select round(avg(m), 8) as reward, round(avg(s), 8) as reward_std, round(avg(flat::int), 8) as frac_zero_std from m""",
)
def reward_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = advantages.reward_metrics(scored(spark, sf_dir), "reward", "prompt")
    return df.select(*[F.round(c, 8).alias(c) for c in df.columns])


@query(
    "i05_minmax",
    """with s as (select l_orderkey prompt, l_linenumber::bigint line, l_discount x, min(l_discount) over w lo, max(l_discount) over w hi from lineitem window w as (partition by l_orderkey))
    select prompt, line, round(case when lo = hi then case when lo = 0 then 0 else least(1, lo) end else (x - lo) / (hi - lo + 1e-5) end, 8) as score from s""",
)
def minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("prompt", "line", F.round(advantages.scaled_scores("r1", "prompt"), 8).alias("score"))


@query(
    "i06_best_of_n",
    """with s as (select l_orderkey prompt, l_linenumber::bigint line, max(l_discount) x, bool_or(l_tax > 0.02) good from lineitem group by 1, 2),
    r as (select *, row_number() over (partition by prompt order by x desc, line) pick, first_value(line) over (partition by prompt order by x, line desc) rejected from s)
    select prompt, line as chosen, rejected, pick::bigint as pick from r where pick <= 2 and good and line <> rejected""",
)
def best_of_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("prompt"), F.col("l_linenumber").cast("long").alias("line"), F.col("l_discount").alias("x"), (F.col("l_tax") > 0.02).alias("good"))
    df = df.groupBy("prompt", "line").agg(F.max("x").alias("x"), F.bool_or("good").alias("good"))
    return advantages.best_of_n(df, "prompt", "line", "x", "good", 2)


@query(
    "v14_routed_teachers",
    "select doc_id, 'teacher-' || lang as teacher from documents",
)
def routed_teachers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang")
    teachers = spark.createDataFrame([(x, f"teacher-{x}") for x in ("de", "en", "es", "fr")], "lang string, teacher string")
    return docs.join(F.broadcast(teachers), "lang", "left").select("doc_id", F.coalesce("teacher", F.raise_error(F.lit("no teacher for this tag")).cast("string")).alias("teacher"))


# --- metrics ---------------------------------------------------------------------------------


@query("g01_channel_mean", "select lang, round(avg(n_chars), 8) as mean, count(*)::bigint as n from documents group by lang")
def channel_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").groupBy("lang").agg(F.round(F.avg("n_chars"), 8).alias("mean"), F.count("*").alias("n"))


@query(
    "g10_length_stats",
    """select source, round(avg(n_chars), 6) as mean, round(stddev_pop(n_chars), 6) as std, min(n_chars) as low, max(n_chars) as high, count(*)::bigint as n from documents group by source""",
)
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.stats(load(spark, sf_dir, "documents"), "n_chars", ["source"])


@query(
    "g05_exact_match",
    "select round(avg((quality = toxic)::int), 9) as accuracy, count(*)::bigint as n from labels",
)
def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "labels").agg(F.round(F.avg((F.col("quality") == F.col("toxic")).cast("double")), 9).alias("accuracy"), F.count("*").alias("n"))


@query(
    "g07_mrr_ndcg",
    """with r as (select doc_id, quality, doc_id // 8 g, (doc_id * 7919) % 1009 s from labels), k as (select *, row_number() over (partition by g order by s desc, doc_id) rk, row_number() over (partition by g order by quality desc, s desc, doc_id) ideal from r),
    m as (select g, max(case when quality = 1 then 1.0::double / rk end) mrr, sum((pow(2, quality) - 1) / log2(rk + 1)) dcg, sum((pow(2, quality) - 1) / log2(ideal + 1)) idcg from k group by g having count(*) > 1 and max(quality) = 1)
    select round(avg(mrr), 8) as mrr, round(avg(dcg / idcg), 8) as ndcg, count(*)::bigint as n_groups from m""",
)
def mrr_ndcg(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("rel"), F.floor(F.col("doc_id") / 8).alias("g"), (F.col("doc_id") * 7919 % 1009).alias("s"))
    return metrics.ranking(df, "g", "s", "rel", "doc_id")


PAIRS = """with p as (select a.vec_id // 2 pair, a.embedding a, b.embedding b, (a.label = b.label)::int y from embeddings a join embeddings b on b.vec_id = a.vec_id + 1 where a.vec_id % 2 = 0),
m as (select pair, y, list_sum(list_transform(list_zip(a, b), lambda z: z[1]::double * z[2]::double)) dot,
list_sum(list_transform(list_zip(a, b), lambda z: abs(z[1]::double - z[2]::double))) l1, sqrt(list_sum(list_transform(list_zip(a, b), lambda z: pow(z[1]::double - z[2]::double, 2)))) l2,
sqrt(list_sum(list_transform(a, lambda z: z::double * z::double))) * sqrt(list_sum(list_transform(b, lambda z: z::double * z::double))) nn from p) """


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    a = e.where("vec_id % 2 = 0").select(F.floor(F.col("vec_id") / 2).alias("pair"), F.col("embedding").alias("a"), F.col("label").alias("la"))
    b = e.where("vec_id % 2 = 1").select(F.floor(F.col("vec_id") / 2).alias("pair"), F.col("embedding").alias("b"), F.col("label").alias("lb"))
    return a.join(b, "pair").select("pair", "a", "b", (F.col("la") == F.col("lb")).cast("int").alias("y"))


@query("g08_pair_similarity", PAIRS + "select pair, round(dot / nn, 6) as cosine, round(-l1, 5) as l1, round(-l2, 6) as l2, round(dot, 6) as dot from m")
def pair_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    return vector_pairs(spark, sf_dir).select(
        "pair", F.round(metrics.cosine(a, b), 6).alias("cosine"), F.round(-metrics.manhattan(a, b), 5).alias("l1"), F.round(-metrics.euclidean(a, b), 6).alias("l2"), F.round(metrics.dot(a, b), 6).alias("dot")
    )


@query(
    "g08_pearson_spearman",
    PAIRS + """, k as (select dot / nn c, y, rank() over (order by dot / nn) + (count(*) over (partition by dot / nn) - 1) / 2.0 rc, rank() over (order by y) + (count(*) over (partition by y) - 1) / 2.0 ry from m)
    select round(corr(c, y), 6) as pearson, round(corr(rc, ry), 6) as spearman from k""",
)
def pearson_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = vector_pairs(spark, sf_dir).select(metrics.cosine(F.col("a"), F.col("b")).alias("c"), F.col("y").cast("double").alias("y"))
    return metrics.correlations(df, "c", "y")


@query(
    "v15_infonce_loss",
    """with e as (select vec_id, vec_id // 4 g, vec_id % 4 k, embedding v from embeddings), p as (select a.g, b.k, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1]::double * z[2]::double)) / 0.1 s from e a join e b on a.g = b.g and a.k = 0 and b.k > 0)
    select g::bigint as g, round(ln(sum(exp(s))) - max(s) filter (where k = 1), 6) as loss from p group by g having count(*) filter (where k = 1) = 1""",
)
def infonce_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("g"), (F.col("vec_id") % 4).alias("k"), "embedding")
    anchor = e.where("k = 0").select("g", F.col("embedding").alias("a"))
    sims = e.where("k > 0").join(anchor, "g").select("g", "k", (metrics.dot(F.col("a"), F.col("embedding")) / F.lit(0.1)).alias("s"))
    return metrics.contrastive_loss(sims, "g", "s", F.col("k") == 1)


@query(
    "g09_infonce_margin",
    """with e as (select vec_id // 4 g, vec_id % 4 k, embedding v from embeddings), p as (select a.g, b.k, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1]::double * z[2]::double)) s from e a join e b on a.g = b.g and a.k = 0 and b.k > 0),
    m as (select g, max(s) filter (where k = 1) p, avg(s) filter (where k > 1) n, max(s) filter (where k > 1) h from p group by g)
    select round(avg(p), 6) as mean_pos, round(avg(n), 6) as mean_neg, round(avg(p - h), 6) as margin from m""",
)
def infonce_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 4).alias("g"), (F.col("vec_id") % 4).alias("k"), "embedding")
    anchor = e.where("k = 0").select("g", F.col("embedding").alias("a"))
    sims = e.where("k > 0").join(anchor, "g").select("g", "k", metrics.dot(F.col("a"), F.col("embedding")).alias("s"))
    groups = sims.groupBy("g").agg(F.max(F.when(F.col("k") == 1, F.col("s"))).alias("p"), F.avg(F.when(F.col("k") > 1, F.col("s"))).alias("n"), F.max(F.when(F.col("k") > 1, F.col("s"))).alias("h"))
    return groups.agg(F.round(F.avg("p"), 6).alias("mean_pos"), F.round(F.avg("n"), 6).alias("mean_neg"), F.round(F.avg(F.col("p") - F.col("h")), 6).alias("margin"))


@query(
    "g14_early_stop",
    """with e as (select user_id, event_id, ts, value, max(value) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) best from events where value is not null),
    i as (select *, sum(case when best is null or value > best then 1 else 0 end) over (partition by user_id order by ts, event_id) island from e),
    s as (select user_id, island, count(*) - 1 streak from i group by all) select user_id, max(streak)::bigint as longest from s group by user_id""",
)
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").where("value is not null")
    return metrics.streaks(df, "user_id", ["ts", "event_id"], "value")


@query(
    "s19_smoothing",
    """with e as (select user_id, value, row_number() over (partition by user_id order by ts, event_id) i, count(*) over (partition by user_id) n from events where value is not null)
    select user_id, round(sum(pow(0.9, n - i) * value) / sum(pow(0.9, n - i)), 6) as last from e group by user_id""",
)
def smoothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "value"))), lambda x: x["value"])
    df = load(spark, sf_dir, "events").where("value is not null").groupBy("user_id").agg(values.alias("v"))
    return df.select("user_id", F.round(F.element_at(metrics.smoothed(F.col("v"), 0.9), -1), 6).alias("last"))


@query(
    "g04_token_accuracy",
    """with w as (select doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') w from documents),
    h as (select doc_id, case when len(w) > 1 then list_transform(range(2, len(w) + 1), lambda i: (w[i] = w[i - 1])::int) else [] end h from w)
    select doc_id, case when len(h) > 0 then round(list_sum(h) / len(h)::double, 9) end as token_acc, (len(list_filter(h, lambda x: x = 0)) = 0) as seq_acc from h""",
)
def token_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words predicted as their predecessors."""
    words = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    df = load(spark, sf_dir, "documents").select("doc_id", words.alias("labels"))
    hits = metrics.shifted_hits(F.col("labels"), F.col("labels"), lambda x: x.isNotNull())
    return df.withColumn("hits", hits).select("doc_id", F.round(metrics.share(F.col("hits")), 9).alias("token_acc"), F.forall("hits", lambda x: x == 1).alias("seq_acc"))


@query("g06_rouge_bleu")
def rouge_bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item against the next one."""
    b = load(spark, sf_dir, "benchmark").select("item_id", "text")
    nxt = b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("reference"))
    return metrics.text_overlap(b.join(nxt, "item_id"), "item_id", "text", "reference")
