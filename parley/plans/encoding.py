"""Queries of templates by rounds, and of token rows and batches for each kind of training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.messages import MESSAGES, message
from parley.operators import encode
from parley.plans.registry import load, query

FULL = "text is not null and lang is not null and source is not null and n_chars is not null"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where(FULL)


def turns(*pairs: tuple[str, Column]) -> Column:
    return F.array(*[message(F.lit(role), content) for role, content in pairs]).cast(MESSAGES)


def two_rounds() -> Column:
    return turns(("system", F.col("source")), ("user", F.col("text")), ("assistant", F.col("lang")), ("user", F.col("lang")), ("assistant", F.col("text")))


N = "chr(10)"
WRITTEN = {
    "chatml": f"'<|im_start|>system' || {N} || source || '<|im_end|>' || {N} || '<|im_start|>user' || {N} || text || '<|im_end|>' || {N} || '<|im_start|>assistant' || {N} || lang || '<|im_end|>' || {N} || '<|im_start|>user' || {N} || lang || '<|im_end|>' || {N} || '<|im_start|>assistant' || {N} || text || case when ends_with(text, '<|im_end|>') then '' else '<|im_end|>' || {N} end",
    "llama2": f"'<s>[INST] <<SYS>>' || {N} || source || {N} || '<</SYS>>' || {N} || {N} || '[INST] ' || text || ' [/INST]' || lang || '</s><s>[INST] ' || lang || ' [/INST]' || text || '</s>'",
    "mistral_nemo": f"'<s>[INST]' || text || '[/INST]' || lang || '</s>[INST]' || source || {N} || {N} || lang || '[/INST]' || text || '</s>'",
    "numbered": f"'[Round 1]' || {N} || {N} || 'Q: ' || text || {N} || {N} || 'A: ' || lang || {N} || {N} || '[Round 2]' || {N} || {N} || 'Q: ' || lang || {N} || {N} || 'A: ' || text",
}


def _rounds_query(name: str) -> None:
    @query(f"t02_rounds_{name}", f"select doc_id, md5({WRITTEN[name]}) as text from documents where {FULL}")
    def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
        return docs(spark, sf_dir).select("doc_id", F.md5(encode.by_rounds(two_rounds(), encode.ROUNDS[name]).cast("binary")).alias("text"))


for _name in WRITTEN:
    _rounds_query(_name)


@query("t02_rounds_prompt", f"select doc_id, md5('[Round 1]' || {N} || {N} || 'Q: ' || text || {N} || {N} || 'A: ' || lang || {N} || {N} || '[Round 2]' || {N} || {N} || 'Q: ' || lang || {N} || {N} || 'A: ') as prompt, md5(text) as bare from documents where {FULL}")
def rounds_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a model is given to go on from, in a format with round numbers and in none."""
    numbered = encode.ROUNDS["numbered"]
    lone = turns(("user", F.col("text")))
    md5 = lambda c: F.md5(c.cast("binary"))
    return docs(spark, sf_dir).select("doc_id", md5(encode.by_rounds(two_rounds(), numbered, train=False)).alias("prompt"), md5(encode.by_rounds(lone, numbered.bare(), train=False)).alias("bare"))


IDS = f"""with d as (select doc_id, lang, source, n_chars, list_transform(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''), lambda w: length(w)) t,
  [length(lang)] l, [length(source)] s from documents where {FULL}) """
SUM = "coalesce(list_sum({x}), 0)::bigint"


def total(c: Column | str) -> Column:
    return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)


def trained(c: Column | str) -> Column:
    return total(F.filter(c, lambda x: x != -100))


@query("t23_encode_causal", IDS + f"select doc_id, {SUM.format(x='t')} + length(lang) as ids, {SUM.format(x='t')} as trained, (len(t) + 1)::integer as length from d")
def encode_causal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", turns(("user", F.col("lang")), ("assistant", F.col("text"))).alias("messages"))
    out = encode.encode(rows, "causal_lm", encode.word_ids, "doc_id")
    return out.select("doc_id", total("input_ids").alias("ids"), trained("labels").alias("trained"), F.col("lengths")[0].alias("length"))


@query("t24_encode_pairs", IDS + f"select doc_id, {SUM.format(x='t')} as chosen, length(source)::bigint as rejected, (doc_id % 2 = 0) as label, (len(t) + 1)::integer as a, 2::integer as b from d")
def encode_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", turns(("user", F.col("lang")), ("assistant", F.col("text"))).alias("messages"), F.col("source").alias("rejected_response"), (F.col("doc_id") % 2 == 0).alias("label"))
    out = encode.encode(rows, "kto", encode.word_ids, "doc_id")
    return out.select("doc_id", trained("chosen_labels").alias("chosen"), trained("rejected_labels").alias("rejected"), "label", F.col("lengths")[0].alias("a"), F.col("lengths")[1].alias("b"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lone = lambda role, c: F.array(F.struct(F.lit(role).alias("role"), F.col(c).alias("content")))
    return docs(spark, sf_dir).select("doc_id", turns(("user", F.col("text"))).alias("messages"), F.array(lone("assistant", "lang")).alias("positive_messages"), F.array(lone("assistant", "source"), lone("assistant", "lang")).alias("negative_messages"))


@query("t24_encode_embedding", IDS + "select doc_id, len(t)::varchar || ',1,1,1' as lengths, '1,0,0' as labels from d")
def encode_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(encode.encode(candidates(spark, sf_dir), "embedding", encode.word_ids, "doc_id"))


@query("t24_encode_reranker", IDS + "select doc_id, (len(t) + 1)::varchar || ',' || (len(t) + 1)::varchar || ',' || (len(t) + 1)::varchar as lengths, '1,0,0' as labels from d")
def encode_reranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(encode.encode(candidates(spark, sf_dir), "reranker", encode.word_ids, "doc_id"))


def shown(df: DataFrame) -> DataFrame:
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return df.select("doc_id", listed("lengths").alias("lengths"), listed("labels").alias("labels"))


@query("t24_encode_classes", IDS + f"select doc_id, {SUM.format(x='t')} as ids, (doc_id % 4)::integer as label, len(t)::integer as length from d")
def encode_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", turns(("user", F.col("text")), ("assistant", F.col("lang"))).alias("messages"), (F.col("doc_id") % 4).cast("int").alias("label"))
    out = encode.with_length(encode.encode(rows, "seq_cls", encode.word_ids, "doc_id"), "input_ids")
    return out.select("doc_id", total("input_ids").alias("ids"), "label", "length")


@query("t16_python_tokenizer", IDS + f"select doc_id, {SUM.format(x='t')} as ids from d")
def python_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tokenizer in Python, in Arrow batches."""
    import re

    lengths = encode.python_tokenizer(lambda texts: [[len(w) for w in re.split("[ \t\n\f\r]+", t) if w] for t in texts])
    return docs(spark, sf_dir).select("doc_id", lengths("text").alias("ids")).select("doc_id", total("ids").alias("ids"))


@query("t21_masked_chunks", IDS + f", c as (select doc_id, unnest(range(0, len(t), 50)) a, t from d) select doc_id, (a // 50)::integer as chunk, {SUM.format(x='t[a + 1:a + 50]')} as ids, {SUM.format(x='t[a + 2:a + 50]')} as trained from c")
def masked_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", encode.word_ids(F.col("text")).alias("input_ids"))
    out = encode.masked_chunks(rows.withColumn("labels", F.col("input_ids")), 50)
    return out.select("doc_id", "chunk", total("input_ids").alias("ids"), trained("labels").alias("trained"))


@query("t27_collated", IDS + f", b as (select doc_id // 8 b, (max(len(t)) + 7) // 8 * 8 n from d group by 1) select doc_id, n::integer as size, len(t)::bigint as kept, {SUM.format(x='t')} as ids, (n - len(t))::integer as ignored from d join b on b.b = d.doc_id // 8")
def collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", F.floor(F.col("doc_id") / 8).alias("b"), encode.word_ids(F.col("text")).alias("input_ids"))
    out = encode.collated(rows.withColumn("labels", F.col("input_ids")), "b", side="left", multiple=8)
    return out.select("doc_id", F.size("input_ids").alias("size"), total("attention_mask").alias("kept"), total("input_ids").alias("ids"), F.size(F.filter("labels", lambda x: x == -100)).alias("ignored"))


@query("t28_paired_batches", f"with d as (select doc_id, doc_id // 4 b, row_number() over (partition by doc_id // 4 order by doc_id) - 1 k, count(*) over (partition by doc_id // 4) n from documents where {FULL}) select doc_id, 0.0::double as margin, (k + s * n)::integer as place, s::integer as side, 2::integer as length from d, (select unnest([0, 1]) s)")
def paired_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", turns(("user", F.col("lang")), ("assistant", F.col("source"))).alias("messages"), F.col("lang").alias("rejected_response"))
    out = encode.paired_batches(encode.encode(rows, "rlhf", encode.word_ids, "doc_id").withColumn("b", F.floor(F.col("doc_id") / 4)), "doc_id", "b")
    return out.select("doc_id", "margin", "place", "side", F.size("input_ids").alias("length"))
