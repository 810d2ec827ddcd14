"""Queries of row objects, sampling and inference, registries, providers' formats, and further dataset algebra."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import extensions, providers, rewards
from parley.functions.messages import MESSAGES, message
from parley.operators import algebra, inference, normalize, packing, rows
from parley.plans.recipes import digest
from parley.plans.registry import load, query

FULL = "text is not null and lang is not null and source is not null and n_chars is not null"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where(FULL)


def turns(*pairs: tuple[str, Column]) -> Column:
    return F.array(*[message(F.lit(role), content) for role, content in pairs]).cast(MESSAGES)


def md5(text: Column) -> Column:
    return F.md5(text.cast("binary"))


# --- rows ------------------------------------------------------------------------------------


@query("n02_mapped_rows", f"select doc_id, unnest(case when doc_id % 3 = 1 then [lang] when doc_id % 3 = 2 then [lang, source] else [] end) as answer from documents where {FULL}")
def mapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """None, one or two rows of each, as its number modulo three says."""
    row = lambda c: F.struct(F.col(c).alias("answer"))
    made = F.when(F.col("doc_id") % 3 == 1, rows.one(row("lang"))).when(F.col("doc_id") % 3 == 2, F.array(row("lang"), row("source")))
    return rows.mapped(docs(spark, sf_dir), made, "doc_id")


@query("n03_checked_rows", "select doc_id, null::varchar as error from documents where text is not null and lang = 'en' union all select * from (select doc_id, case when text is null then 'text' else 'lang' end as error from documents where text is null or lang is null or lang <> 'en' order by doc_id limit 0)")
def checked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine, _ = rows.checked(load(spark, sf_dir, "documents"), {"text": F.col("text").isNotNull(), "lang": F.col("lang") == "en"})
    return fine.select("doc_id", F.lit(None).cast("string").alias("error"))


@query("n08_checked_boxes", "select doc_id, least(doc_id % 10, doc_id % 7)::double as x, least(doc_id % 6, doc_id % 5)::double as y from documents")
def checked_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.array(*[(F.col("doc_id") % k).cast("double") for k in (10, 6, 7, 5)])
    found = load(spark, sf_dir, "documents").select("doc_id", normalize.checked_boxes(F.array(box)).alias("b"))
    return found.select("doc_id", F.col("b")[0][0].alias("x"), F.col("b")[0][1].alias("y"))


@query("n09_media_list", "select page_id, 1::bigint as n, url as path from pages where url is not null")
def media_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").where("url is not null")
    found = pages.select("page_id", normalize.media_list(F.col("url"), pages.schema["url"].dataType).alias("m"))
    return found.select("page_id", F.size("m").cast("long").alias("n"), F.col("m")[0]["path"].alias("path"))


@query("n22_repaired_messages", f"select doc_id, md5('user:' || lang || chr(1) || 'assistant:' || source) as messages from documents where {FULL}")
def repaired_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists as literals of Python or JSON that lack a comma."""
    one = lambda role, c, q: F.concat(F.lit(f"{{{q}role{q}: {q}{role}{q}, {q}content{q}: {q}"), F.col(c), F.lit(f"{q}}}"))
    written = lambda q: F.concat(F.lit("["), one("user", "lang", q), F.lit("\n "), one("assistant", "source", q), F.lit("]"))
    text = F.when(F.col("doc_id") % 2 == 0, written("'")).otherwise(written('"'))
    return docs(spark, sf_dir).select("doc_id", rows.repaired_messages(text).alias("messages")).select("doc_id", digest().alias("messages"))


@query("n23_class_labels", "select doc_id, (doc_id % 5)::integer as label from documents where doc_id % 5 < 4")
def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("doc_id") % 5 < 4, (F.col("doc_id") % 5).cast("string")).otherwise("none")
    return rows.class_labels(load(spark, sf_dir, "documents").select("doc_id", label.alias("label")))


@query("n30_standard_input", f"select doc_id, case when doc_id % 2 = 0 then lang else source end as system, md5('user:' || text || chr(1) || 'tool:' || source) as messages from documents where {FULL}")
def standard_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = turns(("user", F.col("text")), ("tool_response", F.col("source")))
    led = F.when(F.col("doc_id") % 2 == 0, F.concat(turns(("system", F.col("lang"))), held)).otherwise(held)
    out = rows.standard_input(docs(spark, sf_dir).select("doc_id", led.alias("messages"), F.col("source").alias("system")))
    return out.select("doc_id", "system", digest().alias("messages"))


@query("n31_sides", f"select doc_id, md5('user:' || text || chr(1) || 'assistant:' || lang) as chosen, md5('user:' || text || chr(1) || 'assistant:' || source) as rejected, lang as image from documents where {FULL}")
def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = docs(spark, sf_dir).select("doc_id", turns(("user", F.col("text")), ("assistant", F.col("lang"))).alias("messages"), F.col("source").alias("rejected_response"), F.array("lang").alias("images"))
    out = rows.sides(rows_)
    return out.select("doc_id", digest("chosen.messages").alias("chosen"), digest("rejected.messages").alias("rejected"), F.col("rejected.images")[0].alias("image"))


@query("n40_teacher_view", f"select doc_id, md5('user:' || lang || chr(1) || 'assistant:' || source || chr(1) || 'user:' || case when doc_id % 2 = 0 then text || '!' else lang end || chr(1) || 'assistant:' || lang) as messages from documents where {FULL}")
def teacher_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = turns(("user", F.col("lang")), ("assistant", F.col("source")), ("user", F.col("lang")), ("assistant", F.col("lang")))
    prompt = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("!")))
    return docs(spark, sf_dir).select("doc_id", rows.teacher_view(held, prompt).alias("messages")).select("doc_id", digest().alias("messages"))


@query("n41_reward_row", f"select md5(source) as completion, doc_id, lang from documents where {FULL}")
def reward_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = docs(spark, sf_dir).select("doc_id", "lang", "n_chars", turns(("user", F.col("lang")), ("assistant", F.col("source"))).alias("messages"))
    row = rows.reward_row(given, "n_chars")
    return row.select(md5(F.col("completion")).alias("completion"), "row.doc_id", "row.lang")


# --- providers -------------------------------------------------------------------------------


def quoted(c: Column) -> Column:
    return F.substring(F.to_json(F.struct(c.alias("x"))), 6, 2**31 - 1)


def as_json(c: Column) -> Column:
    """The text as a JSON string."""
    whole = quoted(c)
    return F.substring(whole, F.lit(1), F.length(whole) - 1)


@query(
    "n19_listed_calls",
    f"""select doc_id, md5('user:' || text || chr(1) || 'assistant:' || lang || chr(1) || 'tool_call:{{"name":"' || source || '","arguments":{{"n":' || n_chars::varchar || '}}}}' || chr(1) || 'tool_call:{{"name":"' || lang || '","arguments":{{}}}}') as messages, 'openai' as format from documents where {FULL}""",
)
def listed_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.concat(F.lit('{"type":"function","function":{"name":'), as_json(F.col("source")), F.lit(',"arguments":"{\\"n\\": '), F.col("n_chars").cast("string"), F.lit('}"}}'))
    whole = F.concat(F.lit('[{"role":"user","content":'), as_json(F.col("text")), F.lit('},{"role":"assistant","content":'), as_json(F.col("lang")), F.lit(',"tool_calls":['), call, F.lit(',{"name":'), as_json(F.col("lang")), F.lit("}]}]"))
    found = docs(spark, sf_dir).select("doc_id", providers.normalized(whole).alias("n"))
    return found.select("doc_id", digest("n.messages").alias("messages"), "n.format")


@query(
    "n20_block_calls",
    f"""select doc_id, md5('assistant:' || text || lang || chr(1) || 'tool_call:{{"name":"' || source || '","arguments":{{"n":' || n_chars::varchar || '}}}}' || chr(1) || 'assistant:<image>' || chr(1) || 'tool_response:' || text) as messages, 'http://x/' || lang as image, 'anthropic' as format from documents where {FULL}""",
)
def block_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.concat(F.lit('{"type":"text","text":'), as_json(F.col(c)), F.lit("},"))
    use = F.concat(F.lit('{"type":"tool_use","id":"1","name":'), as_json(F.col("source")), F.lit(',"input":{"n":'), F.col("n_chars").cast("string"), F.lit("}},"))
    image = F.concat(F.lit('{"type":"image","source":{"type":"url","url":"http://x/'), F.col("lang"), F.lit('"}}'))
    result = F.concat(F.lit('{"role":"user","content":[{"type":"tool_result","tool_use_id":"1","content":'), as_json(F.col("text")), F.lit("}]}"))
    whole = F.concat(F.lit('[{"role":"assistant","content":['), text("text"), text("lang"), use, image, F.lit("]},"), result, F.lit("]"))
    found = docs(spark, sf_dir).select("doc_id", providers.normalized(whole).alias("n"))
    return found.select("doc_id", digest("n.messages").alias("messages"), F.col("n.images")[0].alias("image"), "n.format")


@query("n29_media_by_kind", f"select doc_id, md5('user:' || lang || '<image><audio><video>') as messages, lang as image, source as audio, lang as video from documents where {FULL}")
def media_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = lambda kind, c: F.concat(F.lit(f',{{"type":"{kind}_url","{kind}_url":{{"url":'), as_json(F.col(c)), F.lit("}}"))
    whole = F.concat(F.lit('[{"role":"user","content":[{"type":"text","text":'), as_json(F.col("lang")), F.lit("}"), block("image", "lang"), block("audio", "source"), block("video", "lang"), F.lit("]}]"))
    n = docs(spark, sf_dir).select("doc_id", providers.normalized(whole).alias("n"))
    return n.select("doc_id", digest("n.messages").alias("messages"), *[F.col(f"n.{k}s")[0].alias(k) for k in providers.MEDIA])


@query("r06_action_reward", f"select doc_id, case when doc_id % 3 = 0 then 1.0 else 0.0 end::double as reward from documents where {FULL}")
def action_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same call with its keys in another order, one with another value, and one that is no JSON."""
    call = lambda given: F.concat(F.lit("Thought: "), F.col("lang"), F.lit("\nAction: "), F.col("source"), F.lit("\nAction Input: "), given)
    n = F.col("n_chars").cast("string")
    wanted = F.concat(F.lit('{"n": '), n, F.lit(', "l": "x"}'))
    given = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('{"l": "x", "n": '), n, F.lit("}"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit('{"l": "y", "n": '), n, F.lit("}"))).otherwise("x")
    return docs(spark, sf_dir).select("doc_id", providers.action_reward(call(given), call(wanted)).alias("reward"))


# --- rewards and registries ------------------------------------------------------------------


@query("r11_process_reward", "select doc_id, case doc_id % 4 when 0 then doc_id % 10 / 10.0::double when 1 then (doc_id % 10)::double else 0.0 end as reward from documents")
def process_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    told = F.when(d % 4 == 0, F.concat(F.lit("well\nReward: **0."), (d % 10).cast("string"), F.lit("**"))).when(d % 4 == 1, F.concat(F.lit("Reward: "), (d % 10).cast("string"))).when(d % 4 == 2, "Reward: high").otherwise("0.7")
    return load(spark, sf_dir, "documents").select("doc_id", rewards.process_reward(told).alias("reward"))


@query("r11_judge_prompt", f"select doc_id, md5('The question is:' || chr(10) || lang || chr(10) || case when doc_id % 2 = 0 then 'The reference answer is:' || chr(10) || source || chr(10) else '' end || 'The response is:' || chr(10) || text || chr(10) || 'Give your score after ''Reward: ''.') as prompt from documents where {FULL}")
def judge_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = F.when(F.col("doc_id") % 2 == 0, F.col("source"))
    return docs(spark, sf_dir).select("doc_id", md5(rewards.judge_prompt(F.col("lang"), F.col("text"), truth)).alias("prompt"))


@query("r10_python_reward", f"select doc_id, case when n_chars > 1000 then null else n_chars / 1000.0::double end as reward from documents where {FULL}")
def python_reward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reward in Python with a further column, which leaves long texts out."""

    def score(completions: list[str], n_chars: list[int]) -> list:
        return [None if n > 1000 else n / 1000.0 for _, n in zip(completions, n_chars, strict=True)]

    return docs(spark, sf_dir).select("doc_id", extensions.python_reward(score, "text", "n_chars").alias("reward"))


@query("g03_python_metric", "select lang, max(n_chars)::double - min(n_chars)::double as spread from documents where n_chars is not null group by lang")
def python_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = extensions.python_metric(lambda v: v.max() - v.min())
    return load(spark, sf_dir, "documents").where("n_chars is not null").groupBy("lang").agg(spread("n_chars").alias("spread"))


@query("r14_total_scores", "select doc_id, case when doc_id % 3 = 0 then null else doc_id % 3 end + 0.5::double * (doc_id % 2) + case when doc_id % 5 = 0 then 10 else 0 end as total_reward from documents where doc_id % 3 <> 0 union all select doc_id, 0.5::double * (doc_id % 2) + case when doc_id % 5 = 0 then 10 else 0 end from documents where doc_id % 3 = 0")
def total_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    given = load(spark, sf_dir, "documents").select("doc_id", F.when(d % 3 != 0, (d % 3).cast("double")).alias("a"), (d % 2).cast("double").alias("b"), F.when(d % 5 == 0, 10.0).alias("gym"))
    return extensions.total_scores(given, ["a", "b"], [1.0, 0.5], "gym").select("doc_id", "total_reward")


@query("u_registered_rewards", f"select doc_id, 1.0::double as ends, 0.0::double as format from documents where {FULL}")
def registered_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's reward beside one that is there."""
    extensions.register("reward", "ends", exist_ok=True)(lambda c: F.endswith(c, F.lit(".")).cast("double"))
    found = extensions.reward_columns(docs(spark, sf_dir).withColumn("c", F.concat("text", F.lit("."))), "c", ["ends", "format"])
    return found.select("doc_id", "ends", "format")


# --- sampling and inference ------------------------------------------------------------------


@query("i01_cached_answers", "select user_id, count(*)::bigint as n, string_agg(event_type, ',' order by event_id) as choices from events where user_id % 2 = 0 group by user_id")
def cached_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").where("user_id % 2 = 0")
    found = inference.cached(events, "user_id", "event_type", "event_id")
    return found.select("user_id", F.size("choices").cast("long").alias("n"), F.array_join("choices", ",").alias("choices"))


@query("i03_reused_answers", "with c as (select user_id, count(*) n from events where event_id % 7 = 0 group by user_id), u as (select distinct user_id from events) select user_id, coalesce(n = 3, false) as reused from u left join c using (user_id)")
def reused_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    cache = inference.cached(events.where("event_id % 7 = 0"), "user_id", "event_type", "event_id")
    hit, miss = inference.reused(events.select("user_id").distinct(), cache, "user_id", 3)
    return hit.select("user_id", F.lit(True).alias("reused")).union(miss.select("user_id", F.lit(False)))


@query("i04_expanded_requests", f"select doc_id, unnest([0, 1, 2])::integer as choice, md5('system:be brief' || chr(1) || 'user:' || text) as messages from documents where {FULL}")
def expanded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = turns(("system", F.col("lang")), ("user", F.col("text")), ("assistant", F.col("source")))
    out = inference.expanded(docs(spark, sf_dir).select("doc_id", held.alias("messages")), 3, "be brief")
    return out.select("doc_id", "choice", digest().alias("messages"))


@query("i06_hard_groups", "with e as (select user_id, sum((value > 150)::int) r from events where value is not null group by user_id) select count(*)::bigint as n from events where value is not null and user_id in (select user_id from e where r - 1 < 12)")
def hard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = load(spark, sf_dir, "events").where("value is not null").withColumn("ok", (F.col("value") > 150).cast("int"))
    return inference.hard_groups(rows_, "user_id", "ok", 20, 0.6).agg(F.count("*").alias("n"))


@query("i07_distilled", f"select doc_id, md5(case when doc_id % 2 = 0 then '<think>' || text || '</think>' || chr(10) || chr(10) || '<answer>' || lang || '</answer>' else lang end) as answer from documents where {FULL}")
def distilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", md5(inference.distilled(F.when(F.col("doc_id") % 2 == 0, F.col("text")), F.col("lang"))).alias("answer"))


@query("i08_answered", f"select doc_id, upper(lang) || '!' as response from documents where {FULL}")
def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.answered(docs(spark, sf_dir).select("doc_id", "lang"), "lang", lambda texts: [t.upper() + "!" for t in texts]).select("doc_id", "response")


@query("i09_scored_results", f"select round(avg((lang = case when doc_id % 3 = 0 then 'en' else lang end)::int), 9) as acc, count(*)::bigint as n from documents where {FULL}")
def scored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = docs(spark, sf_dir).withColumn("told", F.when(F.col("doc_id") % 3 == 0, "en").otherwise(F.col("lang")))
    return inference.scored_results(results, "told", "lang").select(F.round("acc", 9).alias("acc"), "n")


@query(
    "i10_finished_turns",
    """with r as (select user_id, event_id, row_number() over w n, coalesce(max((event_type = 'error')::int) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) cut
    from events window w as (partition by user_id order by event_id)) select user_id, count(*)::bigint as turns, max(event_id) as last from r where n <= 6 and cut = 0 group by user_id""",
)
def finished_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = load(spark, sf_dir, "events").withColumn("why", F.when(F.col("event_type") == "error", "length").otherwise("stop"))
    return inference.finished(rows_, "user_id", "event_id", "why", 6).groupBy("user_id").agg(F.count("*").alias("turns"), F.max("event_id").alias("last"))


@query(
    "i10_rollouts",
    "select l_orderkey as session, count(*)::integer as turns, 2 * count(*)::integer as n_ids, sum(l_linenumber)::bigint as trained, (count(*) filter (where l_linenumber = 5) = 0) as whole from lineitem group by l_orderkey",
)
def rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("session"), F.struct("l_linenumber", "l_partkey", "l_extendedprice").alias("turn"), F.array("l_partkey", "l_suppkey").alias("ids"), F.array(F.lit(0), F.col("l_linenumber").cast("int")).alias("mask"),
        F.when(F.col("l_linenumber") == 5, F.array(F.lit(-0.1))).otherwise(F.array(F.lit(-0.1), F.lit(-0.2))).alias("logprobs"),
    )
    out = inference.rollouts(rows_, "session", "turn", "ids", "mask", "logprobs")
    total = F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("session", "turns", F.size("ids").alias("n_ids"), total.alias("trained"), F.col("logprobs").isNotNull().alias("whole"))


@query("i11_before_marks", f"select doc_id, md5(case when doc_id % 3 = 2 then text else lang end) as head from documents where {FULL} and not contains(text, '<answer>') and not contains(text, '</think>')")
def before_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.when(F.col("doc_id") % 3 == 2, F.col("text")).otherwise(F.concat("lang", F.when(F.col("doc_id") % 3 == 0, "</think>").otherwise("<answer>"), "text", F.lit("<answer>")))
    return docs(spark, sf_dir).where("not contains(text, '<answer>') and not contains(text, '</think>')").select("doc_id", md5(inference.before_marks(marked)).alias("head"))


@query("i12_top_logprobs", "select doc_id, case when doc_id % 2 = 0 then 'b,a' else 'c,b' end as top, case when n_chars >= 1000 then 'length' when doc_id % 2 = 0 then 'stop' end as reason, least(500, 4096 - n_chars)::bigint as room from documents where n_chars is not null")
def top_logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("doc_id") % 2 == 0
    entry = lambda t, p: F.struct(F.lit(t).alias("token"), p.alias("logprob"))
    entries = F.array(entry("a", F.lit(-1.0)), entry("b", F.lit(-0.5)), entry("c", F.when(even, -2.0).otherwise(-0.5 + 0.1)))
    top = F.array_join(F.transform(inference.top_logprobs(entries, 2), lambda e: e["token"]), ",")
    rows_ = load(spark, sf_dir, "documents").where("n_chars is not null")
    return rows_.select("doc_id", top.alias("top"), inference.finish_reason(F.col("n_chars"), F.lit(1000), even).alias("reason"), inference.clamped_tokens(F.lit(500), F.col("n_chars"), 4096).cast("long").alias("room"))


# --- dataset algebra and packing -------------------------------------------------------------


@query("d03_split_streaming", "with r as (select doc_id, row_number() over (order by doc_id) rn from documents) select doc_id, case when rn <= 30 then 'val' else 'train' end as part from r where rn <= 120")
def split_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 120 rows are taken, a quarter of which are held out: take and skip are the feature."""
    return algebra.split_in_order(load(spark, sf_dir, "documents").select("doc_id"), 120, 0.25, "doc_id")


@query(
    "d05_drawn",
    """with s as (select k slot, ('0x' || substr(md5('42:' || k::varchar), 1, 13))::bigint::double / 4503599627370496.0::double u from (select unnest(range(0, 4 * (select count(*) from documents) + 100)) k)),
    p as (select slot, case when u < 0.5 then 'src0' when u < 0.75 then 'src1' else 'src2' end source from s), q as (select *, row_number() over (partition by source order by slot) - 1 k from p),
    n as (select source, count(*) n from documents where source in ('src0', 'src1', 'src2') group by source), e as (select min(slot) e from q join n using (source) where k = n),
    r as (select doc_id, source, row_number() over (partition by source order by doc_id) - 1 k from documents) select q.slot::bigint as slot, doc_id, source from q join r using (source, k) where slot < (select e from e)""",
)
def drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.drawn(load(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", {"src0": 0.5, "src1": 0.25, "src2": 0.25}).select("slot", "doc_id", "source")


@query("d09_batches", "with r as (select doc_id, row_number() over (order by doc_id) - 1 rn, count(*) over () n from documents) select doc_id, (rn // 32)::bigint as batch from r where rn < n // 32 * 32")
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.batches(load(spark, sf_dir, "documents").select("doc_id"), 32, "doc_id")


@query("d10_strided", "select doc_id, ((row_number() over (order by doc_id) - 1) % 7)::bigint as shard from documents")
def strided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.strided_shard(load(spark, sf_dir, "documents").select("doc_id"), 7, "doc_id")


@query("d19_epochs", "with r as (select doc_id, row_number() over (order by doc_id) - 1 rn, count(*) over () n from documents) select doc_id, e::bigint as epoch, (rn + e * n)::bigint as place from r, (select unnest(range(0, 3)) e)")
def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.epochs(load(spark, sf_dir, "documents").select("doc_id"), 3, "doc_id")


@query("p03_windowed_fit")
def windowed_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs depend on the order in which a window's rows are placed, which SQL has no form for; tests hold them against a loop."""
    return packing.windowed_fit(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id", 16384, workers=4)


@query("p04_pack_shards", "select * from (values (1, 5000, 1), (4, 5000, 4), (8, 5000, 5), (8, 10, 1), (8, 0, 1)) t(workers, n, shards)")
def pack_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = [(1, 5000), (4, 5000), (8, 5000), (8, 10), (8, 0)]
    return spark.createDataFrame([(w, n, packing.pack_shards(n, w)) for w, n in given], "workers int, n int, shards int")


@query("p05_row_lengths", "select l_orderkey as key, sum(l_linenumber)::bigint as packed, max(l_linenumber)::bigint as filtered from lineitem group by l_orderkey")
def row_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.collect_list("l_linenumber").alias("n"))
    return held.select("key", packing.row_length(F.col("n")).alias("packed"), packing.row_length(F.col("n"), packed=False).alias("filtered"))
