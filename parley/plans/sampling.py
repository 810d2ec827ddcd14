"""Queries of replacement, negative sampling, buffers and location checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import urls
from parley.operators import resample
from parley.plans.registry import load, query

HASH = "md5(doc_id::varchar || ':42'), doc_id"


@query(
    "d15_replace_failed",
    f"""with g as (select doc_id, row_number() over (order by {HASH}) - 1 k from documents where doc_id % 10 <> 3),
    b as (select doc_id slot, (row_number() over (order by doc_id) - 1) % (select count(*) from g) k from documents where doc_id % 10 = 3)
    select doc_id, doc_id as slot from g union all select g.doc_id, b.slot from b join g using (k)""",
)
def replace_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.replaced(load(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id") % 10 == 3, "doc_id")


@query("d16_refill", "select doc_id from documents where doc_id < 165 and doc_id % 2 = 0 order by doc_id limit 15")
def refill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen valid rows out of 165 attempts: the limits are the feature."""
    return resample.refilled(load(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id") % 2 == 0, 15, "doc_id")


@query(
    "n37_fixed_negatives",
    "select doc_id, 4::bigint as n, least(doc_id % 7, 4)::bigint as own from documents",
)
def fixed_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.slice(F.array(*[F.lit(i) for i in range(7)]), F.lit(1), (F.col("doc_id") % 7).cast("int"))
    found = resample.fixed_negatives(own, F.array(F.lit(100), F.lit(101)), 4, F.col("doc_id"))
    return load(spark, sf_dir, "documents").select("doc_id", found.alias("f")).select("doc_id", F.size("f").cast("long").alias("n"), F.size(F.filter("f", lambda x: x < 100)).cast("long").alias("own"))


@query(
    "n38_ranked_candidates",
    """with c as (select doc_id // 16 q, doc_id, quality from labels), p as (select *, row_number() over (partition by q order by md5(doc_id::varchar || ':42'), doc_id) r from c where quality = 1),
    a as (select q, doc_id g from p where r <= 1), n as (select g, c.q, c.doc_id, row_number() over (partition by g order by md5(g::varchar || ':' || c.doc_id::varchar || ':42'), c.doc_id) r from a join c on a.q = c.q and c.quality = 0)
    select g as "group", q, g as doc_id, 1::integer as quality from a union all select g, q, doc_id, 0::integer from n where r <= 2""",
)
def ranked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "labels").select(F.floor(F.col("doc_id") / 16).alias("q"), "doc_id", F.col("quality").cast("int").alias("quality"))
    return resample.ranked_candidates(df, "q", "quality", "doc_id", 1, 2)


@query(
    "d06_buffer_shuffle",
    f"""with r as (select doc_id, (row_number() over (order by doc_id) - 1) // 100 run from documents)
    select doc_id, (run * 100 + row_number() over (partition by run order by {HASH}) - 1)::bigint as place from r""",
)
def buffer_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.shuffled_buffers(load(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], "doc_id", 100)


@query("s16_public_urls", "select page_id, page_id % 4 = 0 as public from pages")
def public_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 4
    url = F.when(k == 0, F.col("url")).when(k == 1, "http://169.254.169.254/latest").when(k == 2, "file:///etc/passwd").otherwise("https://10.0.0.8:80/x")
    return load(spark, sf_dir, "pages").select("page_id", urls.is_public(url).alias("public"))
