"""Queries of losses, masks and diagnostics over order lines as tokens, and over embeddings as pairs and candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import metrics
from parley.operators import losses
from parley.plans.registry import load, query
from parley.plans.training import TOKENS, token_rows

PLACES = 7


def rounded(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *[(F.round(c, PLACES) + F.lit(0.0)).alias(c) for c in df.columns if c not in keys])


def r(x: str, name: str) -> str:
    return f"round(({x})::double, {PLACES}) + 0.0::double as {name}"


# a request is an order, its rows are lines; the prompt is the customer's number modulo 500
REQUESTS = """with q as (select l_orderkey req, o_custkey % 500 prompt, l_linenumber::bigint * 10000000 + l_partkey ord, l_extendedprice::double / 1000 rew from lineitem join orders on l_orderkey = o_orderkey),
u as (select req, arg_max(prompt, (ord, prompt, rew)) prompt, arg_max(rew, (ord, prompt, rew)) rew from q group by req) """


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("l_orderkey").alias("req"), (F.col("o_custkey") % 500).alias("prompt"), (F.col("l_linenumber").cast("long") * 10000000 + F.col("l_partkey")).alias("ord"), (F.col("l_extendedprice").cast("double") / 1000).alias("rew"))


@query(
    "v07_dynamic_groups",
    REQUESTS + f""", a as (select req, (rew - avg(rew) over w) / (coalesce(stddev_samp(rew) over w, 0) + 1e-4) adv from u window w as (partition by prompt))
    select req, ord::bigint as ord, {r("adv", "advantage")} from q join a using (req)""",
)
def dynamic_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = losses.dynamic_advantage(requests(spark, sf_dir), "rew", "prompt", "req", "ord")
    return rounded(out.select("req", F.col("ord").cast("long").alias("ord"), "advantage"), "req", "ord")


@query(
    "v07_dynamic_batch",
    REQUESTS + f""", a as (select req, prompt, case when count(*) over w > 1 then (rew - avg(rew) over w) * count(*) over w / (count(*) over w - 1) else rew - avg(rew) over w end adv from u window w as (partition by prompt)),
    s as (select stddev_samp(rew) s from u) select req, ord::bigint as ord, {r("adv / (s + 1e-4)", "advantage")} from q join a using (req), s""",
)
def dynamic_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = losses.dynamic_advantage(requests(spark, sf_dir), "rew", "prompt", "req", "ord", baseline="rloo", scale="batch")
    return rounded(out.select("req", F.col("ord").cast("long").alias("ord"), "advantage"), "req", "ord")


@query("v13_rank_share", "select o_orderkey from orders where o_orderkey >= 2000 and o_orderkey < 3000")
def rank_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third of the ranks' shares of a thousand keys each: a slice is the feature."""
    return losses.rank_share(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 2, 1000)


SEQUENCE = TOKENS + ", s as (select seq, avg(nw - od) lr from t where m = 1 group by seq) "


@query("v12_sequence_ratio", SEQUENCE + f"select t.seq, count(*)::bigint as n, {r('max(coalesce(lr, 0))', 'log_ratio')} from t left join s using (seq) group by t.seq")
def sequence_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = losses.with_importance(token_rows(spark, sf_dir), "new", "old", "seq", level="sequence")
    return rounded(out.groupBy("seq").agg(F.count("*").alias("n"), F.max("log_ratio").alias("log_ratio")), "seq", "n")


@query(
    "v12_soft_gate",
    TOKENS + f""", x as (select seq, -a * case when a > 0 then 4 / (1 + exp(-(exp(nw - od) - 1))) else 4 / 1.05 / (1 + exp(-1.05 * (exp(nw - od) - 1))) end v from t where m = 1)
    select {r("avg(v)", "loss")} from (select avg(v) v from x group by seq)""",
)
def soft_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import policy

    rows = token_rows(spark, sf_dir).withColumn("x", losses.soft_gate(F.col("new") - F.col("old"), F.col("adv")))
    return rounded(policy.loss(rows, "x", "mask", "seq").select("loss"))


@query(
    "v12_contrast",
    TOKENS + f""", s as (select seq % 100 g, seq, avg(nw - od) / 0.5 s, avg(a) a from t where m = 1 group by 1, 2),
    k as (select g, sum(exp(s)) filter (where a <= 0) d, sum(exp(-s)) filter (where a > 0) u from s group by g)
    select {r("sum(case when d is not null and u is not null then ln(1 + d) + ln(1 + u) else 0 end) / count(*)", "loss")} from k""",
)
def contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_rows(spark, sf_dir).withColumn("g", F.col("seq") % 100)
    return rounded(losses.contrast_loss(rows, "new", "old", "adv", "seq", "g"))


@query("v12b_top_entropy", TOKENS + ", h as (select quantile_cont(-od, 0.8) h from t where m = 1) select seq, count(*)::bigint as n from t, h where m = 1 and -od >= h group by seq")
def top_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = losses.top_entropy(token_rows(spark, sf_dir).withColumn("entropy", -F.col("old").cast("double")), "entropy", 0.2)
    return rows.where("kept").groupBy("seq").agg(F.count("*").alias("n"))


@query("v12c_entropy_logs", TOKENS + f", e as (select avg(-od::double) m from t where m = 1 group by seq) select {r('avg(m)', 'entropy_mean')}, {r('max(m)', 'entropy_max')}, {r('min(m)', 'entropy_min')} from e")
def entropy_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.entropy_logs(token_rows(spark, sf_dir).withColumn("entropy", -F.col("old").cast("double")), "entropy", "seq"))


@query("v12d_overlong", "select l_orderkey as seq, sum(case when l_returnflag = 'A' then 0 else (l_linenumber % 3 <> 0)::int end)::bigint as trained from lineitem group by l_orderkey")
def overlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("seq"), (F.col("l_linenumber") % 3 != 0).cast("int").alias("mask"), F.when(F.col("l_returnflag") == "A", "length").otherwise("stop").alias("why"))
    return losses.without_overlong(rows, "why").groupBy("seq").agg(F.sum("mask").alias("trained"))


@query("v12g_clip_ratios", TOKENS + f"select {r('avg((exp(nw - od) < 0.8 and a < 0)::int)', 'low')}, {r('avg((exp(nw - od) > 1.2 and a > 0)::int)', 'high')}, {r('avg(((exp(nw - od) < 0.8 and a < 0) or (exp(nw - od) > 1.2 and a > 0))::int)', 'region')} from t where m = 1")
def clip_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.clip_ratios(losses.with_importance(token_rows(spark, sf_dir), "new", "old", "seq"), "log_ratio", "adv"))


@query(
    "g17_correction",
    TOKENS + f""", w as (select least(exp(nw - od), 2) w, (exp(nw - od) > 2)::int c from t where m = 1)
    select {r("avg(w)", "mean")}, {r("stddev_pop(w)", "std")}, {r("min(w)", "min")}, {r("max(w)", "max")}, {r("avg(c)", "truncated")}, {r("pow(sum(w), 2) / sum(w * w) / count(*)", "ess")} from w""",
)
def correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.correction_metrics(losses.with_importance(token_rows(spark, sf_dir), "new", "old", "seq"), "log_ratio"))


GATED = TOKENS + ", g as (select seq, m, (nw - od)::double gap, 1 / (1 + exp(-5.0::double * (nw - od))) gate from t), s as (select seq, sum(m * gate * gap) l, sum(m) n from g group by seq) "


@query(
    "v11_gated_distillation",
    GATED + f"""select 'token-mean' as mode, {r("sum(m * gate * gap) / sum(m)", "loss")}, {r("sum(m * gate) / sum(m)", "gate_mean")}, {r("sum(m * (gate > 0.5)::int) / sum(m)", "gate_active")}, {r("sum(m * gap) / sum(m)", "gap_mean")} from g
    union all select 'seq-mean-token-sum', (select {r("avg(l)", "l")} from s), {r("sum(m * gate) / sum(m)", "gate_mean")}, {r("sum(m * (gate > 0.5)::int) / sum(m)", "gate_active")}, {r("sum(m * gap) / sum(m)", "gap_mean")} from g
    union all select 'seq-mean-token-mean', (select {r("avg(l / greatest(n, 1))", "l")} from s), {r("sum(m * gate) / sum(m)", "gate_mean")}, {r("sum(m * (gate > 0.5)::int) / sum(m)", "gate_active")}, {r("sum(m * gap) / sum(m)", "gap_mean")} from g""",
)
def gated_distillation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_rows(spark, sf_dir)
    parts = [rounded(losses.gated_distillation(rows, "new", "old", "seq", mode=m)).withColumn("mode", F.lit(m)) for m in losses.MODES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("g12_channel_loss", f"select l_returnflag as channel, {r('avg(l_extendedprice)', 'loss')}, count(*)::bigint as n from lineitem where l_linenumber % 3 <> 0 group by l_returnflag")
def channel_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("channel"), F.col("l_extendedprice").alias("x"), (F.col("l_linenumber") % 3 != 0).cast("int").alias("mask"))
    return rounded(losses.channel_loss(rows, "x", "channel"), "channel", "n")


@query("g02_inference_stats", "with u as (select user_id, arg_max(event_id, ts) e, arg_max(user_id * 2, ts) p from events where ts is not null group by user_id) select count(*)::bigint as num_samples, sum(p)::bigint as num_prompt_tokens, sum(e)::bigint as num_generated_tokens, round(count(*) / 100.0::double, 7) as samples_s, round(sum(e) / 100.0::double, 7) as tokens_s from u")
def inference_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").where("ts is not null").withColumn("p", F.col("user_id") * 2)
    return rounded(losses.inference_stats(rows, "user_id", "ts", "p", "event_id", 100.0), "num_samples", "num_prompt_tokens", "num_generated_tokens")


# pairs: each vector and the one after it, like if their labels agree
PAIRS = """with v as (select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings),
p as (select a.vec_id id, (a.label = b.label)::int as y, list_cosine_similarity(a.e, b.e) s from v a join v b on b.vec_id = a.vec_id + 1) """


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("label").alias("l2"), F.col("e").alias("e2"))
    return rows.join(after, "vec_id").select(F.col("vec_id").alias("id"), (F.col("label") == F.col("l2")).cast("int").alias("y"), metrics.cosine(F.col("e"), F.col("e2")).alias("s"))


@query("v15_cosine_loss", PAIRS + f"select {r('avg(pow(s - y, 2))', 'loss')} from p")
def cosine_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.LOSSES["cosine"](pairs(spark, sf_dir), "s", "y"))


@query("v15_contrastive", PAIRS + f"select {r('avg(0.5 * case when y = 1 then pow(1 - s, 2) else pow(greatest(0.5 - (1 - s), 0), 2) end)', 'loss')} from p")
def contrastive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.contrastive_loss(pairs(spark, sf_dir), "s", "y"))


@query(
    "v15_online_contrastive",
    PAIRS + f""", b as (select case when count(*) filter (where y = 1) > 1 then max(1 - s) filter (where y = 1) else avg(1 - s) filter (where y = 0) end nr,
      case when count(*) filter (where y = 0) > 1 then min(1 - s) filter (where y = 0) else avg(1 - s) filter (where y = 1) end fr from p)
    select {r("coalesce(sum(pow(1 - s, 2)) filter (where y = 1 and 1 - s > fr), 0) + coalesce(sum(pow(greatest(0.5 - (1 - s), 0), 2)) filter (where y = 0 and 1 - s < nr), 0)", "loss")} from p, b""",
)
def online_contrastive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.online_contrastive_loss(pairs(spark, sf_dir), "s", "y"))


# batches of four queries with a positive and a negative each: groups of 16 vectors, of which 4 take part as queries
BATCH = """with v as (select vec_id, vec_id // 12 b, vec_id % 12 k, list_transform(embedding, lambda x: x::double) e from embeddings),
s as (select q.vec_id q, case when c.k = q.k + 4 then 'positive' when c.k < 4 then 'query' else 'document' end kind, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) s
  from v q join v c on q.b = c.b and q.k < 4 and c.vec_id <> q.vec_id),
d as (select q.vec_id - 4 q, 'pair' kind, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) s from v q join v c on q.b = c.b and q.k between 4 and 7 and c.k >= 4 and c.vec_id <> q.vec_id),
a as (select * from s union all select * from d), p as (select q, max(s) p from a where kind = 'positive' group by q) """


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = load(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 12).alias("b"), (F.col("vec_id") % 12).alias("k"), F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    dot = F.aggregate(F.zip_with("q.e", "c.e", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    other = (F.col("q.b") == F.col("c.b")) & (F.col("c.vec_id") != F.col("q.vec_id"))
    asked = v.where("k < 4").alias("q").join(v.alias("c"), other)
    kind = F.when(F.col("c.k") == F.col("q.k") + 4, "positive").when(F.col("c.k") < 4, "query").otherwise("document")
    twins = v.where("k between 4 and 7").alias("q").join(v.where("k >= 4").alias("c"), other)
    return asked.select(F.col("q.vec_id").alias("q"), kind.alias("kind"), dot.alias("s")).union(twins.select(F.col("q.vec_id") - 4, F.lit("pair"), dot))


CE = "select {x} from (select q, ln(sum(exp(s / 0.1))) - max(p) / 0.1 l from a join p using (q) where {w} group by q)"


@query("v15_infonce_documents", BATCH + CE.format(x=r("avg(l)", "loss"), w="kind in ('positive', 'document')"))
def infonce_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.infonce(scores(spark, sf_dir).where("kind in ('positive', 'document')"), "q", "kind", "s"))


@query("v15_infonce_all", BATCH + CE.format(x=r("avg(l)", "loss"), w="kind in ('positive', 'pair') or s <= p + 0.1"))
def infonce_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.infonce(scores(spark, sf_dir), "q", "kind", "s", margin=0.1))


# ranked candidates: lines of an order, of which the first is the positive
RANKED = "with c as (select l_orderkey g, l_tax::double * 50 - l_discount::double * 30 x, (l_linenumber = 1)::int y from lineitem) "


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("g"), (F.col("l_tax").cast("double") * 50 - F.col("l_discount").cast("double") * 30).alias("x"), (F.col("l_linenumber") == 1).cast("int").alias("y"))


@query("v16_pointwise", RANKED + f"select {r('avg(greatest(x, 0) + ln(1 + exp(-abs(x))) - x * y)', 'loss')} from c")
def pointwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.pointwise_loss(ranked(spark, sf_dir), "x", "y"))


@query("v16_listwise", RANKED + f", l as (select ln(sum(exp(x / 2.0))) - sum(x / 2.0) filter (where y = 1) l from c group by g having count(*) >= 2 and max(y) = 1) select {r('avg(l)', 'loss')} from l")
def listwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.listwise_loss(ranked(spark, sf_dir), "x", "y", "g", temperature=2.0))




@query("g09_infonce_batch", BATCH + f", k as (select q, max(s) filter (where kind = 'positive') p, max(s) filter (where kind = 'document') h from a group by q) select {r('avg(p)', 'mean_pos')}, (select {r('avg(s)', 'x')} from a where kind = 'document') as mean_neg, {r('avg(p - h)', 'margin')} from k")
def infonce_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(losses.infonce_metrics(scores(spark, sf_dir), "q", "kind", "s"))
