"""Queries of specifications, readers, writers and preprocessors: tables are written in public layouts and read again."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import normalize
from parley.plans.recipes import digest
from parley.plans.registry import load, query
from parley.sources import readers
from parley.sources.scratch import folder
from parley.sources.spec import Dataset, Registry, Spec, Subset

FULL = "text is not null and lang is not null and source is not null and n_chars is not null"
DO = "'do' || case when doc_id % 2 = 0 then chr(10) || lang else '' end"
QA = "md5('user:' || {q} || chr(1) || 'assistant:' || {a})"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where(FULL)


def conversations(df: DataFrame, *others: str) -> DataFrame:
    return df.select(*others, digest().alias("messages"))


@query("s01_specs", "select * from (values ('hf::org/data:a/b#500', 'hf', 'org/data', 'a,b', 500), ('data', null, 'data', '', null), ('ms::x/y#7', 'ms', 'x/y', '', 7), ('s3://b/t.parquet:all', null, 's3://b/t.parquet', 'all', null)) t(spec, hub, path, subsets, sample)")
def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = ["hf::org/data:a/b#500", "data", "ms::x/y#7", "s3://b/t.parquet:all"]
    found = [(t, (s := Spec.parse(t, lambda p: False)).hub, s.path, ",".join(s.subsets), s.sample) for t in texts]
    return spark.createDataFrame(found, "spec string, hub string, path string, subsets string, sample int")


@query("s05_registry", "select * from (values ('other/x', 'a,default', 'default'), ('/data/x', 'a,default', 'default'), ('org/y', 'default', 'default'), ('unknown', 'default', 'default')) t(asked, every, one)")
def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup by name, path, hub id and last part; a weak subset is not among all."""
    known = Registry()
    known.register("x", Dataset("/data/x", subsets=[Subset("a"), Subset("b", is_weak=True), Subset("default")]))
    known.register_json(json.dumps([{"dataset_name": "y", "hf_dataset_id": "org/y"}]))
    out = []
    for asked in ("other/x", "/data/x", "org/y", "unknown"):
        d = known.resolve(Spec.parse(asked, lambda p: False))
        out.append((asked, ",".join(s.name for s in d.select(("all",))), ",".join(s.name for s in d.select(()))))
    return spark.createDataFrame(out, "asked string, every string, one string")


@query("s10_jsonl_appended", f"select doc_id, md5(text) as text, lang from documents where {FULL} union all select doc_id, md5(text), null from documents where {FULL} and doc_id % 2 = 0")
def jsonl_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "jsonl") + ".jsonl"
    rows = docs(spark, sf_dir).select("doc_id", "text", "lang")
    readers.write_jsonl(rows, path)
    readers.write_jsonl(rows.where("doc_id % 2 = 0").withColumn("lang", F.lit(None).cast("string")), path)
    return spark.read.schema("doc_id long, text string, lang string").json(path).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text"), "lang")


@query("s11_sanitized", f"select doc_id, '<<<bytes>>>' as raw, lang as name, null::varchar as api_token, '<<<bytes>>>' as inner_raw, true as no_token, source as kept from documents where {FULL}")
def sanitized(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = F.array(F.struct(F.col("text").cast("binary").alias("raw"), F.col("lang").alias("user_token")))
    held = F.create_map(F.lit("a_token"), F.col("lang"), F.lit("k"), F.col("source"))
    rows = docs(spark, sf_dir).select("doc_id", F.col("text").cast("binary").alias("raw"), F.col("lang").alias("name"), F.col("source").alias("api_token"), inner.alias("inner"), held.alias("m"))
    out = readers.sanitized_rows(rows)
    gone = F.col("inner")[0]["user_token"].isNull() & F.col("m")["a_token"].isNull()
    return out.select("doc_id", "raw", "name", "api_token", F.col("inner")[0]["raw"].alias("inner_raw"), gone.alias("no_token"), F.col("m")["k"].alias("kept"))


@query("s13_cached", f"select doc_id, greatest(n_chars, doc_id)::bigint as max_length from documents where {FULL} and greatest(n_chars, doc_id) <= 2000")
def cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "cached")
    readers.write_cached(docs(spark, sf_dir).select("doc_id", "n_chars"), path, F.array("n_chars", "doc_id"))
    return readers.read_cached(spark, path, 2000).select("doc_id", F.col("max_length").cast("long").alias("max_length"))


@query("s13_cached_sample", f"with r as (select doc_id, row_number() over (order by md5(doc_id::varchar || ':42'), doc_id) rn from documents where {FULL}) select doc_id from r where rn <= 50")
def cached_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'#50' of a specification: the sample is the feature."""
    path = folder(spark, "cached")
    readers.write_cached(docs(spark, sf_dir).select("doc_id", "n_chars"), path, F.array("n_chars"))
    return readers.read_cached(spark, f"{path}#50", key="doc_id").select("doc_id")


@query("s14_indexed_rows", f"select doc_id, md5(text) as text from documents where {FULL} and doc_id in (3, 77, 150, 151)")
def indexed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few rows by their number out of all that are stored: the lookup is the feature."""
    path = folder(spark, "indexed")
    readers.write_indexed(docs(spark, sf_dir).select("doc_id", "text"), path, "doc_id")
    return readers.read_rows(spark, path, "doc_id", [3, 77, 150, 151]).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text"))


@query("s18_batches_once", f"select (doc_id % 3)::integer as batch, count(*)::bigint as n, '0,1,2' as written from documents where {FULL} group by 1")
def batches_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, of which one is written again after a failure."""
    path = folder(spark, "batches")
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    for batch in (0, 1, 1, 2):
        readers.write_batch(rows.where(F.col("doc_id") % 3 == batch), path, batch)
    written = ",".join(map(str, readers.written_batches(spark, path)))
    return spark.read.parquet(path).groupBy(F.col("batch").cast("int").alias("batch")).agg(F.count("*").alias("n")).withColumn("written", F.lit(written))


def through(spark: SparkSession, df: DataFrame, kind: str, spec: str = "", **options) -> DataFrame:
    """A table written in a layout and format, and read again as conversations."""
    path = f"{folder(spark, 'layout')}.{kind}"
    if kind == "csv":
        df.write.option("header", True).option("escape", '"').csv(path)
    else:
        df.write.option("ignoreNullFields", False).format({"jsonl": "json"}.get(kind, kind)).save(path)
    return readers.load_dataset(spark, path + spec, **options)


@query("n11_response_layout", f"select {QA.format(q='text', a='lang')} as messages, source as channel from documents where {FULL}")
def response_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer under other names, in Parquet; a known column beside them stays, an unknown one goes."""
    rows = docs(spark, sf_dir).select(F.col("text").alias("question"), F.array("lang", "source").alias("answers"), F.col("source").alias("channel"), F.col("n_chars").alias("odd"))
    return conversations(through(spark, rows, "parquet"), "channel")


@query("n12_history_layout", f"select md5('system:' || source || chr(1) || 'user:' || lang || chr(1) || 'assistant:' || source || chr(1) || 'user:' || text || chr(1) || 'assistant:' || lang) as messages from documents where {FULL}")
def history_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select(F.col("source").alias("system"), F.array(F.array("lang", "source")).alias("history"), F.col("text").alias("query"), F.col("lang").alias("response"))
    return conversations(through(spark, rows, "parquet"))


@query("n14_alpaca_layout", f"select {QA.format(q=DO, a='source')} as messages from documents where {FULL}")
def alpaca_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In CSV, whose empty fields stay empty."""
    rows = docs(spark, sf_dir).select(F.lit("do").alias("instruction"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("input"), F.col("source").alias("output"))
    return conversations(through(spark, rows, "csv"))


def sharegpt(first: str, second: str, role: str = "from", content: str = "value") -> Column:
    one = lambda r, c: F.struct(F.lit(r).alias(role), F.col(c).alias(content))
    return F.array(one(first, "text"), one(second, "lang"))


@query("n15_messages_layout", f"select {QA.format(q='text', a='lang')} as messages, {QA.format(q='text', a='source')} as rejected from documents where {FULL}")
def messages_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and contents under other names, with a rejected conversation of its own, in JSON lines."""
    rejected = F.array(F.struct(F.lit("human").alias("from"), F.col("text").alias("value")), F.struct(F.lit("gpt").alias("from"), F.col("source").alias("value")))
    rows = docs(spark, sf_dir).select(sharegpt("human", "gpt").alias("conversations"), rejected.alias("rejected_messages"))
    out = normalize.auto_preprocess(rows)
    return out.select(digest().alias("messages"), digest("rejected_messages").alias("rejected"))


@query("n17_role_names", f"select doc_id, md5('user:' || text || chr(1) || 'tool_call:' || lang) as messages from documents where {FULL}")
def role_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", sharegpt("human", "function-call").alias("conversations"))
    return normalize.messages_preprocess(rows).select("doc_id", digest().alias("messages"))


@query("n18_paired_layout", f"select {QA.format(q='text', a='lang')} as messages from documents where {FULL}")
def paired_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.array(F.struct(F.col("text").alias("human"), F.col("lang").alias("assistant")))
    return conversations(through(spark, docs(spark, sf_dir).select(pair.alias("conversation")), "parquet"))


@query("n04_renamed_columns", "select 'text,lang,n,kept' as columns, count(*)::bigint as n from documents")
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names count whatever their case; of two columns with one target neither is renamed."""
    rows = load(spark, sf_dir, "documents").select(F.col("text"), F.col("lang"), F.col("n_chars").alias("LENGTH"), F.col("source").alias("kept"))
    out = normalize.rename_columns(rows, {"text": "query", "LANG": "query", "length": "n"})
    return out.agg(F.count("*").alias("n")).withColumn("columns", F.lit(",".join(out.columns)))


@query("n05_standard_columns", "select 'images,label,channel' as columns, count(*)::bigint as n from documents")
def standard_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = normalize.standard_columns(load(spark, sf_dir, "documents").select(F.col("source").alias("channel"), F.col("n_chars").alias("label"), F.col("text").alias("odd"), F.array("lang").alias("images")))
    return out.agg(F.count("*").alias("n")).withColumn("columns", F.lit(",".join(out.columns)))


@query("n07_rejected_rows", f"select {QA.format(q='text', a='lang')} as messages, lang || '!' as rejected_response from documents where {FULL} and doc_id % 3 = 0")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rejected response that is missing or the same as the answer leaves the row out."""
    rejected = F.when(F.col("doc_id") % 3 == 0, F.concat("lang", F.lit("!"))).when(F.col("doc_id") % 3 == 1, F.col("lang"))
    rows = docs(spark, sf_dir).select(F.col("text").alias("query"), F.col("lang").alias("response"), rejected.alias("rejected_response"))
    return conversations(through(spark, rows, "parquet"), "rejected_response")


@query("n01_tagged_datasets", f"select (case when doc_id % 2 = 0 then 'a' else 'b' end) as dataset, {QA.format(q='text', a='lang')} as messages from documents where {FULL}")
def tagged_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two registered datasets of different layouts under each other, each row with its name."""
    known, rows = Registry(), docs(spark, sf_dir)
    paths = {n: f"{folder(spark, 'layout')}.parquet" for n in "ab"}
    rows.where("doc_id % 2 = 0").select(F.col("text").alias("ask"), F.col("lang").alias("response")).write.parquet(paths["a"])
    rows.where("doc_id % 2 = 1").select(sharegpt("human", "gpt").alias("conversations")).write.parquet(paths["b"])
    known.register("a", Dataset(paths["a"], columns={"ask": "query"}))
    known.register("b", Dataset(paths["b"]))
    return conversations(readers.load_dataset(spark, ["a", "b"], known, tag=True), "dataset")


@query("s03_folder_splits", f"select {QA.format(q='text', a='lang')} as messages from documents where {FULL} and doc_id % 3 < 2")
def folder_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subset's folder with two parts of the split that is asked for, and another split that is not."""
    base, rows = folder(spark, "repo"), docs(spark, sf_dir).select("doc_id", F.col("text").alias("query"), F.col("lang").alias("response"))
    for i, name in enumerate(("train-0", "train-1", "test")):
        rows.where(F.col("doc_id") % 3 == i).drop("doc_id").write.parquet(f"{base}/part/{name}.parquet")
    found = readers.read_folder(spark, base, "part", ("train",), tries=2)
    return conversations(normalize.auto_preprocess(found))


@query("s17_val_split_saved", f"with n as (select greatest(floor(count(*) * 0.1), 1) n from documents where {FULL}) select n::bigint as n, true as within from n")
def val_split_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The held-out part is kept beside what is trained on, and read back."""
    from parley.operators import algebra

    path = folder(spark, "val")
    rows = docs(spark, sf_dir).select("doc_id", "text")
    readers.write_jsonl(algebra.split(rows, 0.1, "doc_id").where("part = 'val'").drop("part"), path)
    found = spark.read.schema("doc_id long, text string").json(path)
    return found.join(rows, ["doc_id", "text"], "left").agg(F.count("*").alias("n")).withColumn("within", F.lit(found.join(rows, ["doc_id", "text"], "left_anti").count() == 0))


@query("u_user_loader", "select i::bigint as id, 'row ' || i::varchar as text from (select unnest(range(0, (select count(*) from documents))) i)")
def user_loader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loader in Python in four shards, as many rows as there are documents."""
    from parley.sources import loaders

    return loaders.load(spark, "parley.sources.loaders:counted", "id long, text string", 4, str(load(spark, sf_dir, "documents").count()))
