"""Queries of the general relational surface over the star-schema tables and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.operators import relations
from parley.plans.registry import load, query
from parley.streaming import windows


@query(
    "rel_pricing_summary",
    """select l_returnflag, l_linestatus, round(sum(l_quantity), 4) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 8) as avg_disc, count(*)::bigint as n
    from lineitem where l_shipdate <= timestamp '1998-09-02' group by all""",
)
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp '1998-09-02'")
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 4).alias("sum_qty"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 8).alias("avg_disc"),
        F.count("*").alias("n"),
    )


@query(
    "rel_inner_join",
    """select n_name, count(*)::bigint as n, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name""",
)
def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (load(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return joined.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("rel_left_join", "select c_custkey, count(o_orderkey)::bigint as n from customer left join orders on o_custkey = c_custkey group by c_custkey")
def left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    counts = o.groupBy("o_custkey").agg(F.count("*").alias("n"))  # aggregated before the join: a row per customer is moved
    return c.join(counts, c.c_custkey == counts.o_custkey, "left").select("c_custkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("rel_full_join", "select coalesce(l.doc_id, d.doc_id) as doc_id, l.quality is not null as labelled from documents d full join labels l on d.doc_id = l.doc_id")
def full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, l = load(spark, sf_dir, "documents").select("doc_id"), load(spark, sf_dir, "labels").select(F.col("doc_id").alias("k"), "quality")
    return d.join(l, d.doc_id == l.k, "full").select(F.coalesce("k", "doc_id").alias("doc_id"), F.col("quality").isNotNull().alias("labelled"))


@query("rel_semi_join", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 200000)")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = load(spark, sf_dir, "orders").where("o_totalprice > 200000"), load(spark, sf_dir, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey")


@query("rel_anti_join", "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query(
    "rel_as_of_join",
    """select e.event_id, p.event_id as before_id from (select * from events where event_type <> 'purchase') e
    asof left join (select user_id, ts, max(event_id) event_id from events where event_type = 'purchase' group by 1, 2) p on e.user_id = p.user_id and e.ts >= p.ts""",
)
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each other event with the user's last purchase up to then, in spans of a day."""
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts", (F.col("event_type") == "purchase").alias("buy"))
    return relations.as_of(e, "user_id", "ts", F.col("buy"), "event_id", "before_id").where("not buy").select("event_id", "before_id")


@query("rel_cube", "select l_returnflag, l_linestatus, count(*)::bigint as n from lineitem group by cube (l_returnflag, l_linestatus)")
def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("rel_rollup", "select lang, source, sum(n_chars)::bigint as chars from documents group by rollup (lang, source)")
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").rollup("lang", "source").agg(F.sum("n_chars").alias("chars"))


@query("rel_grouping_sets", "select lang, source, count(*)::bigint as n from documents group by grouping sets ((lang), (source), ())")
def grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "documents")
    return df.groupingSets([[df.lang], [df.source], []], df.lang, df.source).agg(F.count("*").alias("n"))


@query("rel_intersect", "select c_nationkey as k from customer intersect select s_nationkey as k from supplier")
def intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = load(spark, sf_dir, "customer"), load(spark, sf_dir, "supplier")
    return c.select(F.col("c_nationkey").alias("k")).intersect(s.select(F.col("s_nationkey").alias("k")))


@query("rel_except", "select doc_id from documents except select doc_id from labels")
def difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id").exceptAll(load(spark, sf_dir, "labels").select("doc_id").distinct())


@query("rel_top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "rel_top_k_per_group",
    """select o_custkey, o_orderkey, rank from (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey)::integer as rank from orders) where rank <= 2""",
)
def top_k_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return load(spark, sf_dir, "orders").withColumn("rank", rank).where("rank <= 2").select("o_custkey", "o_orderkey", "rank")


@query("rel_distinct_counts", "select event_type, count(distinct user_id)::bigint as users from events group by event_type")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@query("rel_approx_quantiles")
def approx_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "lineitem")
    return df.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey").alias("orders"), F.percentile_approx("l_extendedprice", F.array(F.lit(0.5), F.lit(0.9))).alias("price"))


@query(
    "rel_pivot",
    """select user_id, count(*) filter (where event_type = 'click')::bigint as click, count(*) filter (where event_type = 'purchase')::bigint as purchase from events where event_type in ('click', 'purchase') group by user_id""",
)
def pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events").where("event_type in ('click', 'purchase')")
    return df.groupBy("user_id").pivot("event_type", ["click", "purchase"]).agg(F.count(F.lit(1))).na.fill(0)


@query("rel_json_fields", "select event_id, json_extract_string(props, '$.k') as k, length(props)::bigint as n from events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").cast("long").alias("n"))


@query(
    "rel_url_parts",
    """select page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) as host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as path from pages""",
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), F.coalesce(F.parse_url("url", F.lit("PATH")), F.lit("")).alias("path"))


# --- event time ------------------------------------------------------------------------------


@query("s_tumbling", "select time_bucket(interval '1 hour', ts) as start, event_type, count(*)::bigint as n from events group by all")
def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts(load(spark, sf_dir, "events"), "1 hour", None, ["event_type"])


@query(
    "s_sliding",
    """select time_bucket(interval '30 minutes', ts) - to_minutes(30 * k) as start, count(*)::bigint as n from events, (select unnest([0, 1]) k) group by 1""",
)
def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.counts(load(spark, sf_dir, "events"), "1 hour", "30 minutes", [])


@query(
    "s_session",
    """with e as (select user_id, ts, case when lag(ts) over (partition by user_id order by ts) > ts - interval '6 hours' then 0 else 1 end b from events),
    i as (select *, sum(b) over (partition by user_id order by ts rows unbounded preceding) s from e) select user_id, min(ts) as start, count(*)::bigint as n from i group by user_id, s""",
)
def session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sessions(load(spark, sf_dir, "events"), "user_id", "6 hours")


@query("s_dedup_watermark", "select user_id, event_type, min(ts) as first from events group by all")
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = load(spark, sf_dir, "events")
    return df.groupBy("user_id", "event_type").agg(F.min("ts").alias("first"))
