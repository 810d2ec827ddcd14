"""Queries of further joins, streams, policy arithmetic and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import metrics
from parley.operators import advantages, policy, recipes, relations, resample
from parley.plans.losses import r, rounded
from parley.plans.registry import load, query
from parley.plans.training import TOKENS, token_rows
from parley.sources import readers
from parley.sources.scratch import folder
from parley.streaming import datasets as streams
from parley.streaming import windows

# --- joins and relations ---------------------------------------------------------------------


@query("rel_range_join", "with b as (select item_id, item_id * 40 lo, item_id * 40 + 90 hi from benchmark) select doc_id, item_id from documents join b on n_chars >= lo and n_chars < hi")
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = load(spark, sf_dir, "benchmark").select("item_id", (F.col("item_id") * 40).alias("lo"), (F.col("item_id") * 40 + 90).alias("hi"))
    return relations.range_join(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), ranges, "n_chars", "lo", "hi", 100).select("doc_id", "item_id")


@query("rel_right_join", "select d.doc_id as doc, l.doc_id as labelled from (select * from documents where doc_id % 3 = 0) d right join labels l on d.doc_id = l.doc_id")
def right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = load(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.col("doc_id").alias("doc")), load(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled"))
    return d.join(l, F.col("doc") == F.col("labelled"), "right")


@query("rel_cross_join", "select r_name, n_name from region, nation")
def cross_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of fixed size, of five and 25 rows."""
    return load(spark, sf_dir, "region").select("r_name").crossJoin(load(spark, sf_dir, "nation").select("n_name"))


@query("rel_lateral_join", "select user_id, word, count(*)::bigint as n from events, lateral (select unnest([event_type, event_type || '!']) as word) group by user_id, word")
def lateral_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_type").alias("e")
    words = spark.tvf.explode(F.array(F.col("event_type").outer(), F.concat(F.col("event_type").outer(), F.lit("!"))))
    return events.lateralJoin(words).withColumnRenamed("col", "word").groupBy("user_id", "word").agg(F.count("*").alias("n"))


@query(
    "rel_batch_pairs",
    f"with v as (select vec_id, vec_id // 8 b, list_transform(embedding, lambda x: x::double) e from embeddings) select x.vec_id as a, y.vec_id as b, {r('list_cosine_similarity(x.e, y.e)', 'score')} from v x join v y on x.b = y.b and x.vec_id <> y.vec_id",
)
def batch_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = load(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 8).alias("batch"), F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    return rounded(relations.within_batches(v, "batch", "vec_id", "e", metrics.cosine).select("a", "b", "score"), "a", "b")


@query("rel_zipped_rows", "select doc_id, lang, source from documents")
def zipped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    return relations.zipped(d.select("doc_id", "lang"), d.select("doc_id", "source"), "doc_id")


@query("rel_intersect_all", "select c_nationkey as k from customer intersect all select s_nationkey as k from supplier")
def intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersectAll(load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")))


@query("rel_union_distinct", "select c_nationkey as k from customer union select s_nationkey as k from supplier")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).union(load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))).distinct()


@query(
    "rel_dates",
    "select event_id, date_trunc('hour', ts) as hour, dayofyear(ts)::integer as day, strftime(ts, '%Y-%m-%d') as written, floor(date_part('epoch', ts) / 3600)::bigint as hours, (ts::date + interval '7 days')::date as later from events",
)
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select("event_id", F.date_trunc("hour", "ts").alias("hour"), F.dayofyear("ts").alias("day"), F.date_format("ts", "yyyy-MM-dd").alias("written"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).alias("hours"), F.date_add(F.to_date("ts"), 7).alias("later"))


# --- streams ---------------------------------------------------------------------------------


def as_stream(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """A table written to files and read as a stream of them."""
    path = folder(spark, name)
    rows.repartition(4).write.parquet(path)
    return windows.read(spark, path, rows.schema, files_per_trigger=1)


@query("s_stream_slice", "select count(*)::bigint as n, count(distinct place)::bigint as places, min(place)::bigint as first, max(place)::bigint as last from (select unnest(range(30, 130)) place)")
def stream_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred rows after the first thirty of a stream: take and skip are the feature."""
    out = folder(spark, "slice")
    streams.sliced(as_stream(spark, load(spark, sf_dir, "documents").select("doc_id"), "stream"), out, f"{out}-state", "doc_id", 30, 100).awaitTermination()
    return spark.read.parquet(out).agg(F.count("*").alias("n"), F.countDistinct("place").alias("places"), F.min("place").alias("first"), F.max("place").alias("last"))


@query("s_stream_shuffle", "select doc_id from documents")
def stream_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folder(spark, "shuffle")
    streams.shuffled(as_stream(spark, load(spark, sf_dir, "documents").select("doc_id"), "stream"), out, f"{out}-state", "doc_id", 64).awaitTermination()
    return spark.read.parquet(out).select("doc_id")


@query("s_stream_interleave", "select doc_id, (doc_id % 2)::integer as stream, md5('user:' || text || chr(1) || 'assistant:' || lang) as messages from documents where text is not null and lang is not null")
def stream_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams under each other, through a preprocessor, written once."""
    from parley.operators.instruction_sets import asked
    from parley.plans.recipes import digest

    rows = load(spark, sf_dir, "documents").select("doc_id", "text", "lang").where("text is not null")
    both = streams.interleaved([as_stream(spark, rows.where(F.col("doc_id") % 2 == i), f"stream{i}") for i in range(2)])
    made = streams.mapped(both, lambda df: asked(df, F.col("text"), F.col("lang"), "doc_id", "stream").where("size(messages) = 2"))
    out = folder(spark, "interleave")
    windows.write(made.select("doc_id", "stream", digest().alias("messages")), out, f"{out}-state").awaitTermination()
    return spark.read.schema("doc_id long, stream int, messages string").parquet(out)


@query("s_stream_distinct", "select distinct user_id, event_type from events")
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each key of a stream whose watermark never passes one."""
    rows = load(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    out = folder(spark, "distinct")
    found = windows.distinct(as_stream(spark, rows, "stream"), ["user_id", "event_type"], "3650 days").select("user_id", "event_type")
    windows.write(found, out, f"{out}-state").awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(out)


# --- rewards, advantages and policies --------------------------------------------------------


@query("v08_filled_groups", "with g as (select user_id, min(value) a, max(value) b from events where value is not null group by user_id), k as (select user_id, row_number() over (order by user_id) rn from g where a < b) select user_id from k where rn <= 10")
def filled_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten groups whose rewards differ, from as many rounds as that takes: the batch is the feature."""
    rows = load(spark, sf_dir, "events").where("value is not null").select("user_id", "value")
    halves = [rows.where("user_id < 8"), rows.where("user_id >= 8")]
    return advantages.filled(halves, "value", "user_id", 10).select("user_id").distinct()


@query("v09_teacher_signal", TOKENS + f"select seq, {r('sum(a + 0.5 * m * (nw - od))', 'advantage')}, {r('sum(m * least(exp(least(nw - od, 20)) - (nw - od) - 1, 10))', 'kl')} from t group by seq")
def teacher_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = policy.with_teacher(token_rows(spark, sf_dir), "new", "old", "adv", "mask", 0.5).withColumn("kl", policy.masked_k3(F.col("old"), F.col("new"), F.col("mask"), 10.0))
    return rounded(rows.groupBy("seq").agg(F.sum("adv").alias("advantage"), F.sum("kl").alias("kl")), "seq")


@query("v10_reweighed", TOKENS + f"select seq, {r('sum(a * (0.6 + 0.4 * greatest(least(exp(sign(a) * (nw - od)), 1.2), 0.8)))', 'advantage')} from t group by seq")
def reweighed(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = policy.reweighed(F.array(F.col("new").cast("double")), F.array(F.col("old").cast("double")), F.col("adv"), 0.2, 0.4)
    return rounded(token_rows(spark, sf_dir).select("seq", one[0].alias("x")).groupBy("seq").agg(F.sum("x").alias("advantage")), "seq")


@query(
    "v12e_influence",
    f"""with t as (select l_orderkey seq, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice) i, (-l_discount * 10 + l_tax * 10)::double x, l_quantity / 25.0::double - 1 a from lineitem),
    y as (select *, case when a < 0 and exp(x) > 1.5 then 0 else x end v from t),
    f as (select p.seq, p.i, sum(q.v * pow(0.9, q.i - p.i)) f from y p join y q on p.seq = q.seq and q.i >= p.i group by p.seq, p.i)
    select seq, {r("sum(greatest(least(exp(f), 1.3), 0.7))", "weight")} from f group by seq""",
)
def influence(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.struct("l_linenumber", "l_partkey", "l_extendedprice", (-F.col("l_discount") * 10 + F.col("l_tax") * 10).cast("double").alias("x"), (F.col("l_quantity") / 25.0 - 1).cast("double").alias("a"))
    held = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("seq")).agg(F.sort_array(F.collect_list(row)).alias("t"))
    weights = policy.influence(F.transform("t", lambda z: z["x"]), F.transform("t", lambda z: z["a"]), 0.9, 0.3, 1.5)
    return rounded(held.select("seq", F.aggregate(weights, F.lit(0.0), lambda s, w: s + w).alias("weight")), "seq")


@query("g13_reward_functions", f"select {r('avg(n_chars)', 'length_mean')}, {r('stddev_samp(n_chars)', 'length_std')}, {r('avg(case when doc_id % 3 > 0 then doc_id % 3 end)', 'kind_mean')}, {r('stddev_samp(case when doc_id % 3 > 0 then doc_id % 3 end)', 'kind_std')} from documents")
def reward_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "documents").select(F.col("n_chars").cast("double").alias("length"), F.when(F.col("doc_id") % 3 > 0, (F.col("doc_id") % 3).cast("double")).alias("kind"))
    return rounded(advantages.function_metrics(rows, ["length", "kind"]))


@query("g18_named_metrics", f"select {r('avg((quality = toxic)::int)', 'acc')}, {r('avg(quality)', 'mean')} from labels")
def named_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "labels")
    return rounded(rows.agg(metrics.METRICS["acc"]("quality", "toxic").alias("acc"), metrics.METRICS["mean"]("quality").alias("mean")))


@query("d15_limited_tries", "with g as (select doc_id, row_number() over (order by md5(doc_id::varchar || ':42'), doc_id) - 1 k from documents) select count(*)::bigint as n, (select count(*) from documents where doc_id % 4 = 0)::bigint as replaced from g")
def limited_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter fails; each failed row is replaced within ten tries of its own places in a fixed order."""
    out = resample.replaced_within(load(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id") % 4 == 0, "doc_id")
    return out.agg(F.count("*").alias("n"), F.sum((F.col("slot") != F.col("doc_id")).cast("long")).alias("replaced"))


@query("n27_class_prompts", "select doc_id, md5('Task: Sentiment Classification' || chr(10) || 'Sentence: ' || text || chr(10) || 'Category: negative, positive' || chr(10) || 'Output:') as query, case quality when 0 then 'negative' else 'positive' end as response from documents join labels using (doc_id) where text is not null and quality is not null")
def class_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["negative", "positive"]
    rows = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id").where("text is not null and quality is not null")
    prompt = recipes.class_prompt(F.col("text"), names, "Sentiment Classification")
    return rows.select("doc_id", F.md5(prompt.cast("binary")).alias("query"), F.get(F.array(*map(F.lit, names)), F.col("quality")).alias("response"))


@query("s19_smoothed_steps", f"with w as (select vec_id, list_transform(embedding, lambda x: x::double) e from embeddings), x as (select vec_id, unnest(range(1, 65)) i, e from w), k as (select vec_id, e[i] v, i from x) select vec_id, {r('sum(v * pow(0.9, 64 - i)) / sum(pow(0.9, 64 - i))', 'last')} from k group by vec_id")
def smoothed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    return rounded(rows.select("vec_id", F.element_at(metrics.smoothed(F.col("e"), 0.9), -1).alias("last")), "vec_id")


@query("s_held_windows", "select time_bucket(interval '1 day', ts) as start, count(*)::bigint as n from events group by 1")
def held_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream that is complete: what the batch query gives."""
    rows = load(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    out = folder(spark, "windows")
    counted = windows.counts(as_stream(spark, rows, "stream"), "1 day", None, [], "1 hour")
    name = f"held_{out[-8:]}"
    counted.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    readers.write_jsonl(spark.table(name), out)
    return spark.read.schema("start timestamp, n long").json(out)


# --- further rows of the inventory -----------------------------------------------------------


@query("d07_ranges", "with r as (select doc_id, row_number() over (order by doc_id) - 1 rn, count(*) over () n from documents) select doc_id, 'taken' as part from r where rn < 40 union all select doc_id, 'skipped' from r where rn >= n - 25 union all select doc_id, 'selected' from r where rn in (3, 5, 8)")
def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Take, skip and select by place: they are the feature."""
    from parley.operators import algebra

    docs = load(spark, sf_dir, "documents").select("doc_id")
    placed, total = algebra.numbered(docs, ["doc_id"]), docs.count()
    part = lambda rows, name: rows.select("doc_id", F.lit(name).alias("part"))
    taken = part(docs.orderBy("doc_id").limit(40), "taken")
    return taken.union(part(docs.orderBy("doc_id").offset(max(total - 25, 0)), "skipped")).union(part(placed.where(F.col("rn").isin(3, 5, 8)), "selected"))


@query("e19_answer_classes", "select doc_id, text, 0 as label, lang as answer from documents where lang is not null union all select doc_id, text, 1, source from documents where source is not null")
def answer_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each class has one answer here, so the draw among them is the same in any engine."""
    rows = load(spark, sf_dir, "documents").withColumns({"human": F.array_compact(F.array("lang")), "machine": F.array_compact(F.array("source"))})
    return recipes.answers_exploded(rows, "text", {"human": 0, "machine": 1}, "doc_id").select("doc_id", "text", "label", "answer")


def wordings(task: str, lang: str) -> str:
    from parley.operators.media_sets import GROUNDING

    return "[" + ", ".join(f"'{x}'" for x in GROUNDING[task, lang]) + f"][('0x' || substr(md5('43:' || page_id::varchar), 1, 8))::bigint % {len(GROUNDING[task, lang])} + 1]"


@query("n28_grounding", f"select page_id, md5('user:' || case when ('0x' || substr(md5('42:' || page_id::varchar), 1, 8))::bigint % 100 < 80 then {wordings('grounding', 'en')} else {wordings('grounding', 'zh')} end || chr(1) || 'assistant:<bbox>') as messages from pages")
def grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import media_sets
    from parley.plans.recipes import digest

    return media_sets.grounding_dialog(load(spark, sf_dir, "pages"), "page_id", "grounding", "page_id").select("page_id", digest().alias("messages"))


@query(
    "s16_refusals",
    "select page_id, case page_id % 8 when 0 then 'scheme' when 1 then 'metadata' when 2 then 'metadata' when 3 then 'private' when 4 then 'private' when 5 then 'metadata' when 6 then 'scheme' end as why, case page_id % 8 when 0 then 'scheme' when 1 then 'metadata' when 2 then 'metadata' when 5 then 'metadata' when 6 then 'scheme' end as inside from pages where url is not null",
)
def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.functions import urls

    made = ["ftp://x.org/a", "http://169.254.169.254/latest", "http://[::ffff:169.254.1.1]/", "http://10.1.2.3:80/x", "https://LOCALHOST/x", "http://100.100.100.200/", "file:///etc/passwd"]
    url = F.coalesce(F.get(F.array(*map(F.lit, made)), (F.col("page_id") % 8).cast("int")), F.concat(F.lit("https://example.org/"), F.col("page_id").cast("string")))
    rows = load(spark, sf_dir, "pages").where("url is not null")
    return rows.select("page_id", urls.refusal(url).alias("why"), urls.refusal(url, internal=True).alias("inside"))


@query("t19_protected", "with d as (select doc_id, list_transform(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), lambda w: length(w)) t from documents where text is not null), p as (select doc_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i] = 7) g, list_filter(range(1, len(t) + 1), lambda i: t[i] <> 7) o from d) select doc_id, (len(g) + least(len(o), greatest(32 - len(g), 0)))::integer as n, coalesce(list_sum(list_transform(o[:greatest(32 - len(g), 0)], lambda i: t[i])), 0)::bigint + 7 * len(g) as total from p")
def protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 32 ids, where those equal to 7 must all stay: the cut is the feature."""
    from parley.functions import sequences
    from parley.operators import encode

    rows = load(spark, sf_dir, "documents").where("text is not null").select("doc_id", encode.word_ids(F.col("text")).alias("ids"))
    out = rows.select("doc_id", sequences.truncated(F.col("ids"), 32, F.array(F.lit(7))).alias("x"))
    return out.select("doc_id", F.size("x").alias("n"), F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))


@query("v12_cispo_loss", TOKENS + f"select {r('avg(-least(exp(nw - od), 1.2) * a * (nw - od))', 'loss')} from t where m = 1")
def cispo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_rows(spark, sf_dir).withColumn("x", policy.clipped(F.col("new") - F.col("old"), F.col("adv"), kind="cispo"))
    return rounded(policy.loss(rows, "x", "mask", "seq", "cispo").select("loss"))


@query("v12_bnpo_loss", TOKENS + f"select {r('avg(x)', 'loss')} from l")
def bnpo(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_rows(spark, sf_dir).withColumn("x", policy.clipped(F.col("new") - F.col("old"), F.col("adv")))
    return rounded(policy.loss(rows, "x", "mask", "seq", "bnpo").select("loss"))


@query("i05_candidate_scores", f"with c as (select user_id, event_id, least(value, 100)::double x from events where value is not null), g as (select user_id, min(x) lo, max(x) hi from c group by user_id) select user_id, event_id, x > 50 as mask, {r('case when lo = hi then case when lo = 0 then 0 else least(1, lo) end else (x - lo) / (hi - lo + 1e-5) end', 'score')} from c join g using (user_id)")
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import inference

    rows = load(spark, sf_dir, "events").where("value is not null").select("user_id", "event_id", F.array(F.col("value"), F.lit(100.0)).alias("x"))
    return rounded(inference.candidate_scores(rows, "user_id", "x", 50.0).select("user_id", "event_id", "mask", "score"), "user_id", "event_id", "mask")


@query("i06_with_truth", "select user_id, count(*)::bigint as n, string_agg(case when t then 'T' else 'c' end, '' order by pl) as order_ from (select user_id, event_id::bigint pl, false t from events union all select user_id, 4611686018427387904, true from events group by user_id) group by user_id")
def with_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    from parley.operators import inference

    rows = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.lit("truth").alias("truth"))
    out = inference.candidates_with_truth(rows, "user_id", "event_type", "truth", "event_id")
    held = F.sort_array(F.collect_list(F.struct("at", F.when(F.col("is_truth"), "T").otherwise("c").alias("k"))))
    return out.groupBy("user_id").agg(F.count("*").alias("n"), F.array_join(F.transform(held, lambda x: x["k"]), "").alias("order_"))
