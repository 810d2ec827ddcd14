"""Queries of token sequences, policy arithmetic and recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import sequences as S
from parley.operators import policy, recipes
from parley.plans.registry import load, query


def word_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' word lengths as token ids."""
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return load(spark, sf_dir, "documents").select("doc_id", "lang", F.transform(words, lambda w: F.length(w)).alias("ids"))


IDS = "with d as (select doc_id, lang, list_transform(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), lambda w: length(w)::integer) ids from documents) "
TOTAL = "coalesce(list_sum({}), 0)::bigint"


@query("t16_labels", IDS + "select doc_id, coalesce(list_sum(list_filter(ids[2:], lambda i: i > 3)), 0)::bigint as trained, (len(ids) - len(list_filter(ids[2:], lambda i: i > 3)))::bigint as ignored from d")
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of over three letters are trained on."""
    made = S.labels(F.col("ids"), F.transform("ids", lambda i: (i > 3).cast("double")))
    df = word_ids(spark, sf_dir).select("doc_id", made.alias("l"))
    kept = F.filter("l", lambda x: x != S.IGNORE)
    return df.select("doc_id", F.aggregate(kept, F.lit(0).cast("long"), lambda a, x: a + x).alias("trained"), (F.size("l") - F.size(kept)).cast("long").alias("ignored"))


@query(
    "t19_truncate",
    IDS + """select doc_id, coalesce(list_sum(ids[:64]), 0)::bigint as head, coalesce(list_sum(ids[greatest(len(ids) - 63, 1):]), 0)::bigint as tail from d""",
)
def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return word_ids(spark, sf_dir).select("doc_id", total(S.truncated(F.col("ids"), 64)).alias("head"), total(S.truncated(F.col("ids"), 64, side="left")).alias("tail"))


@query(
    "t26_packed_positions",
    IDS + ", p as (select doc_id // 8 as pack, sum(len(ids)) n, sum(len(ids)::bigint * (len(ids) - 1) // 2) s from d group by 1) select pack::bigint as pack, n::bigint as n, s::bigint as position_sum from p",
)
def packed_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = F.collect_list(F.size("ids"))
    packs = word_ids(spark, sf_dir).groupBy(F.floor(F.col("doc_id") / 8).alias("pack")).agg(lengths.alias("lengths"))
    packs = packs.select("pack", S.positions(F.col("lengths")).alias("p"))
    return packs.select("pack", F.size("p").cast("long").alias("n"), F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x).alias("position_sum"))


@query(
    "t27_padding_waste",
    IDS + ", b as (select doc_id // 16 b, sum(len(ids)) n, max(len(ids)) * count(*) cells from d group by 1) select round(1 - sum(n) / sum(cells)::double, 9) as waste, count(*)::bigint as batches from b",
)
def padding_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = word_ids(spark, sf_dir).groupBy(F.floor(F.col("doc_id") / 16).alias("b")).agg(F.sum(F.size("ids")).alias("n"), (F.max(F.size("ids")) * F.count("*")).alias("cells"))
    return batches.agg(F.round(1 - F.sum("n") / F.sum("cells"), 9).alias("waste"), F.count("*").alias("batches"))


@query("t28_multi_hot", "select doc_id, list_transform(range(0, 5), lambda i: (i = doc_id % 5 or i = doc_id % 3)::int::double) as hot from documents")
def multi_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = F.array((F.col("doc_id") % 5).cast("int"), (F.col("doc_id") % 3).cast("int"))
    return load(spark, sf_dir, "documents").select("doc_id", S.multi_hot(classes, 5).alias("hot"))


@query("t09_media_tags", "select doc_id, repeat('<image>', greatest(doc_id % 4 - 1, 0)::integer) || 'a <image> ' || lang as text from documents")
def media_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", S.media_tags(F.concat(F.lit("a <image> "), "lang"), "<image>", (F.col("doc_id") % 4).cast("int")).alias("text"))


@query(
    "t11_scaled_boxes",
    "select doc_id, [round_even((doc_id % 97) / 640.0::double * 1000, 0)::integer, round_even((doc_id % 89) / 480.0::double * 1000, 0)::integer] as box from documents",
)
def scaled_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.array((F.col("doc_id") % 97).cast("double"), (F.col("doc_id") % 89).cast("double"))
    return load(spark, sf_dir, "documents").select("doc_id", S.scaled_box(box, F.lit(640.0), F.lit(480.0)).alias("box"))


# --- policy ----------------------------------------------------------------------------------


def token_rows(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Lineitems as tokens of their orders: two policies' log probabilities, a mask and an advantage; ``more`` columns after these."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("seq"), (-F.col("l_discount") * 10).alias("new"), (-F.col("l_tax") * 10).alias("old"), (F.col("l_linenumber") % 3 != 0).cast("int").alias("mask"),
        (F.col("l_quantity") / 25.0 - 1).alias("adv"), *more,
    )


TOKENS = """with t as (select l_orderkey seq, -l_discount * 10 nw, -l_tax * 10 od, (l_linenumber % 3 <> 0)::int m, l_quantity / 25.0::double - 1 a from lineitem),
l as (select *, -least(exp(nw - od) * a, greatest(least(exp(nw - od), 1.2), 0.8) * a) x from t where m = 1) """


def surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, sf_dir).withColumn("x", policy.clipped(F.col("new") - F.col("old"), F.col("adv")))


@query("v12_grpo_loss", TOKENS + "select round(avg(s), 7) as loss from (select avg(x) s from l group by seq)")
def grpo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.loss(surrogate(spark, sf_dir), "x", "mask", "seq").select(F.round("loss", 7).alias("loss"))


@query("v12_dapo_loss", TOKENS + "select round(avg(x), 7) as loss from l")
def dapo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.loss(surrogate(spark, sf_dir), "x", "mask", "seq", "dapo").select(F.round("loss", 7).alias("loss"))


@query("v12_dr_grpo_loss", TOKENS + "select round(sum(x) / ((select count(distinct seq) from t) * 8), 7) as loss from l")
def dr_grpo_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy.loss(surrogate(spark, sf_dir), "x", "mask", "seq", "dr_grpo", 8).select(F.round("loss", 7).alias("loss"))


@query(
    "g16_off_policy",
    TOKENS + """select round(avg(od - nw), 8) as kl, round(avg(exp(nw - od) - (nw - od) - 1), 8) as k3_kl, round(exp(-avg(od)), 8) as old_ppl, round(exp(-avg(nw)), 8) as new_ppl, round(avg(exp(2 * (nw - od))) - 1, 8) as chi2 from t where m = 1""",
)
def off_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = policy.diagnostics(token_rows(spark, sf_dir), "old", "new", "mask")
    return df.select(*[F.round(c, 8).alias(c) for c in df.columns])


@query(
    "v12f_sequence_mask",
    TOKENS + "select seq, count(*)::bigint as n from t where seq not in (select seq from t group by seq having avg(od - nw) > 0.1 and max(a) < 0) group by seq",
)
def sequence_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a sequence come in the order in which their rows are stored."""
    tokens = token_rows(spark, sf_dir, F.struct("_metadata.file_path", "_metadata.row_index").alias("at"))
    return policy.sequence_kept(tokens, "old", "new", "adv", "seq", 0.1, "at").groupBy("seq").agg(F.count("*").alias("n"))


@query(
    "v12e_future_sums",
    """with e as (select user_id, event_id, value, row_number() over (partition by user_id order by event_id) i from events where value is not null)
    select user_id, round(sum(pow(0.5, i - 1) * value), 6) as first from e group by user_id""",
)
def future_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.transform(F.sort_array(F.collect_list(F.struct("event_id", "value"))), lambda x: x["value"])
    df = load(spark, sf_dir, "events").where("value is not null").groupBy("user_id").agg(values.alias("v"))
    return df.select("user_id", F.round(F.get(policy.future_sums(F.col("v"), 0.5), F.lit(0)), 6).alias("first"))


@query("v12a_reference_kl", TOKENS + "select seq, round(sum(greatest(least(exp(greatest(least(od - nw, 20), -20)) - greatest(least(od - nw, 20), -20) - 1, 10), -10)), 6) as kl from t group by seq")
def reference_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(spark, sf_dir).groupBy("seq").agg(F.round(F.sum(policy.k3(F.col("new"), F.col("old"), 10.0)), 6).alias("kl"))


# --- recipes ---------------------------------------------------------------------------------


@query("e02_strip_prefix", "select doc_id, case when starts_with(source, 'src1') then source[5:] else source end as source from documents")
def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", recipes.without_prefix(F.col("source"), "src1").alias("source"))


@query("e30_fill_names", "select doc_id, 'I am ' || source || ' by ' || lang as text from documents")
def fill_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", recipes.filled(F.lit("I am {{NAME}} by {{AUTHOR}}"), {"NAME": F.col("source"), "AUTHOR": F.col("lang")}).alias("text"))


@query("m04_option_letters", "select doc_id, chr((65 + doc_id % 5)::integer) as letter from documents")
def option_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", recipes.option_letter((F.col("doc_id") % 5).cast("int")).alias("letter"))


@query("m01_existing_files", "select page_id from pages where url in (select url from pages where page_id % 3 = 0)")
def existing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    return recipes.existing_only(pages, "url", pages.where("page_id % 3 = 0").select(F.col("url").alias("path"))).select("page_id")


@query("m11_spans_apart", "select doc_id, (doc_id % 7 >= doc_id % 5 + 2 or doc_id % 5 >= doc_id % 7 + 2) as apart from documents")
def spans_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = lambda n: F.struct((F.col("doc_id") % n).alias("start"), (F.col("doc_id") % n + 2).alias("end"))
    return load(spark, sf_dir, "documents").select("doc_id", recipes.spans_apart(F.array(span(7), span(5))).alias("apart"))


@query("e05_drop_marked", "select conv_id from conversations group by conv_id having count(*) filter (where contains(lower(text), 'moss')) = 0")
def drop_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.max(F.contains(F.lower("text"), F.lit("moss"))).alias("bad"))
    return rows.where("not bad").select("conv_id")
