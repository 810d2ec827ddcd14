"""Queries of dataset algebra and packing over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import algebra, instruction_sets, packing
from parley.plans.registry import load, query

ORDER = "md5(doc_id::varchar || ':42'), doc_id"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", *columns)


@query(
    "d01_oversample",
    f"""with n as (select count(*) n from documents), r as (select doc_id, row_number() over (order by {ORDER}) rn from documents)
    select doc_id, unnest(range(0, 2))::bigint as copy from documents
    union all select doc_id, 2::bigint as copy from r, n where rn <= (5 * n // 2) % n""",
)
def oversample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return algebra.sample(docs, docs.count() * 5 // 2, "doc_id")


@query(
    "d02_split",
    f"""with r as (select doc_id, row_number() over (order by {ORDER}) rn, count(*) over () n from documents)
    select doc_id, case when rn <= greatest(floor(n * 0.1), 1) then 'val' else 'train' end as part from r""",
)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.split(documents(spark, sf_dir), 0.1, "doc_id")


@query(
    "d03_split_in_order",
    "with r as (select doc_id, row_number() over (order by doc_id) rn from documents) select doc_id, case when rn <= 20 then 'val' else 'train' end as part from r where rn <= 100",
)
def split_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 rows are taken, a fifth of which are held out: take and skip are the feature."""
    taken = documents(spark, sf_dir).orderBy("doc_id").limit(100)
    val = taken.orderBy("doc_id").limit(20).withColumn("part", F.lit("val"))
    return algebra.concat(val, taken.join(val, "doc_id", "left_anti").withColumn("part", F.lit("train")))


@query(
    "d04_concat",
    "select doc_id, lang, null::varchar as source from documents union all select doc_id, null as lang, source from documents",
)
def concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.concat(documents(spark, sf_dir, "lang"), None, documents(spark, sf_dir, "source"))


@query(
    "d05_interleave",
    """with o as (select * from (values (0,'src0',0,2),(1,'src1',0,1),(2,'src0',1,2),(3,'src2',0,1)) t(i, source, k, per)),
    r as (select doc_id, source, row_number() over (partition by source order by doc_id) - 1 rn from documents where source in ('src0','src1','src2')),
    n as (select source, count(*) n from r group by source),
    e as (select min(n // per * 4 + (select i from o o2 where o2.source = o.source and o2.k = n % per)) e from o join n using (source)),
    s as (select slot, o.source, slot // 4 * per + k rn from (select unnest(range(0, (select e from e))) slot) join o on o.i = slot % 4)
    select s.slot::bigint as slot, r.doc_id, r.source from s join r on r.source = s.source and r.rn = s.rn""",
)
def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.interleave(documents(spark, sf_dir, "source"), "source", "doc_id", ["src0", "src1", "src0", "src2"])


@query(
    "d06_shuffle",
    f"select doc_id, (row_number() over (order by {ORDER}) - 1)::bigint as place from documents",
)
def shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.numbered(documents(spark, sf_dir), [algebra.hash_order("doc_id"), F.col("doc_id")], "place")


@query(
    "d08_shard",
    "with r as (select doc_id, row_number() over (order by doc_id) - 1 rn, count(*) over () // 7 piece from documents) select doc_id from r where rn >= 2 * piece and rn < 3 * piece",
)
def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.data_range(documents(spark, sf_dir), 2, 7, "doc_id")


@query(
    "d10_linspace",
    """with r as (select doc_id, row_number() over (order by doc_id) - 1 rn, count(*) over () n from documents),
    b as (select unnest(range(0, 7)) i) select doc_id, i::bigint as shard from r, b where rn >= i * n // 7 and rn < (i + 1) * n // 7""",
)
def linspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.linspace_shard(documents(spark, sf_dir), 7, "doc_id")


@query(
    "d11_rank_batches",
    f"""with r as (select doc_id, row_number() over (order by {ORDER}) - 1 rn, count(*) over () // 4 share from documents)
    select doc_id, (rn % 4)::bigint as rank, (rn // 4 // 16)::bigint as batch from r where rn < share * 4 and rn // 4 // 16 < share // 16""",
)
def rank_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.rank_batches(documents(spark, sf_dir), 4, 16, "doc_id")


@query(
    "d12_length_batches",
    f"""with r as (select doc_id, n_chars, (row_number() over (order by {ORDER}) - 1) // 64 mega from documents),
    p as (select *, row_number() over (partition by mega order by n_chars desc, doc_id) - 1 k from r) select doc_id, (mega * 8 + k // 8)::bigint as batch, n_chars from p""",
)
def length_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.length_batches(documents(spark, sf_dir, "n_chars"), "n_chars", "doc_id", 8, 8).select("doc_id", "batch", "n_chars")


@query(
    "d17_keep_last",
    "select lang, max(doc_id) as doc_id, arg_max(source, doc_id) as source from documents group by lang",
)
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return algebra.keep_last(documents(spark, sf_dir, "lang", "source"), "lang", "doc_id")


@query(
    "d18_first_seen",
    "select source, min(doc_id) as first from documents group by source",
)
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "source").groupBy("source").agg(F.min("doc_id").alias("first"))


WORDS = "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"


@query("t20_delete_overlong", f"select doc_id, {WORDS}::bigint as length from documents where {WORDS} <= 256")
def delete_overlong(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).cast("long")
    return documents(spark, sf_dir, "text").select("doc_id", length.alias("length")).where("length <= 256")


@query(
    "t21_split_chunks",
    f"""with w as (select doc_id, {WORDS} n from documents), c as (select doc_id, n, unnest(range(0, (n + 127) // 128)) chunk from w)
    select doc_id, chunk::bigint as chunk, least(128, n - chunk * 128)::bigint as length from c""",
)
def split_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    df = documents(spark, sf_dir, "text").select("doc_id", packing.chunks(words, 128).alias("chunks"))
    return df.select("doc_id", F.posexplode("chunks").alias("chunk", "w")).select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.size("w").cast("long").alias("length"))


NEXT_FIT = """with recursive d as (select doc_id, n_chars len, row_number() over (order by doc_id) rn from documents),
p(rn, doc_id, len, used, pack) as (select rn, doc_id, len, len, 0 from d where rn = 1
union all select d.rn, d.doc_id, d.len, case when p.used >= 8192 or p.used + d.len > 8192 then d.len else p.used + d.len end,
case when p.used >= 8192 or p.used + d.len > 8192 then p.pack + 1 else p.pack end from p join d on d.rn = p.rn + 1) """


@query("p01_next_fit", NEXT_FIT + "select doc_id, pack::bigint as pack_id from p")
def next_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.next_fit(documents(spark, sf_dir, "n_chars"), "n_chars", "doc_id", 8192).select("doc_id", "pack_id")


@query("p06_pack_utilisation", NEXT_FIT + ", k as (select pack, count(*) n, sum(len) total from p group by pack) select count(*)::bigint as packs, sum(total)::bigint as total, round(avg(total / 8192.0::double), 9) as fill from k")
def pack_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.next_fit(documents(spark, sf_dir, "n_chars"), "n_chars", "doc_id", 8192)
    packs = packed.groupBy("pack_id").agg(F.sum("n_chars").alias("total"))
    return packs.agg(F.count("*").alias("packs"), F.sum("total").alias("total"), F.round(F.avg(F.col("total") / 8192.0), 9).alias("fill"))


@query("p02_best_fit_pack")
def best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(documents(spark, sf_dir, "n_chars"), "n_chars", "doc_id", 16384)


@query(
    "n35_kto_kl",
    """with r as (select doc_id, row_number() over (order by doc_id) - 1 rn, text c from documents), b as (select *, rn // 8 batch from r),
    x as (select doc_id, coalesce(lag(c) over w, last_value(c) over (partition by batch order by rn rows between unbounded preceding and unbounded following)) c from b window w as (partition by batch order by rn))
    select doc_id, md5(c) as rejected from x""",
)
def kto_kl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole responses go one row on within their batch; what comes back is a digest."""
    out = packing.rotate_in_batches(documents(spark, sf_dir, "text"), "text", "doc_id", 8, "rejected")
    return out.select("doc_id", F.md5(F.col("rejected").cast("binary")).alias("rejected"))


@query(
    "n36_kto_bounds",
    """with c as (select greatest(sum(quality), 1) d, greatest(count(*) - sum(quality), 1) u from labels)
    select d::bigint as desirable, u::bigint as undesirable, round(u / d::double, 2) as low, round(u * 1.33 / d::double, 2) as high from c""",
)
def kto_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = load(spark, sf_dir, "labels").agg(F.greatest(F.sum("quality"), F.lit(1)).alias("d"), F.greatest(F.count("*") - F.sum("quality"), F.lit(1)).alias("u"))
    ratio = F.col("u") / F.col("d").cast("double")
    return counts.select(F.col("d").cast("long").alias("desirable"), F.col("u").cast("long").alias("undesirable"), F.round(ratio, 2).alias("low"), F.round(F.col("u") * 1.33 / F.col("d").cast("double"), 2).alias("high"))


@query(
    "e31_chunk9",
    """with c as (select doc_id, length(text) n, regexp_replace(replace(text, '.', '0'), '(.{9})', '\\1' || chr(10), 'gs') x from documents where text is not null)
    select doc_id, md5(case when n > 0 and n % 9 = 0 then left(x, length(x) - 1) else x end) as rows from c""",
)
def chunk9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as boards: lines of nine cells."""
    boards = instruction_sets.sudoku_rows(documents(spark, sf_dir, "text").where("text is not null"), "text", "doc_id")
    return boards.select("doc_id", F.md5(F.col("rows").cast("binary")).alias("rows"))


@query("e07_keep_kinds", "select doc_id, source from documents where source in ('src1', 'src3', 'src5')")
def keep_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir, "source").where(F.col("source").isin("src1", "src3", "src5"))


@query(
    "e19_explode",
    "select doc_id, unnest([0, 1])::bigint as label, unnest([lang, source]) as answer from documents",
)
def explode_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.array(*[F.struct(F.lit(i).cast("long").alias("label"), F.col(c).alias("answer")) for i, c in enumerate(("lang", "source"))])
    return documents(spark, sf_dir, "lang", "source").select("doc_id", F.explode(pair).alias("x")).select("doc_id", "x.label", "x.answer")


@query(
    "m07_negative_pool",
    """with r as (select d.doc_id, b.item_id, row_number() over (partition by d.doc_id order by md5(d.doc_id::varchar || ':' || b.item_id::varchar), b.item_id) rn
    from documents d, benchmark b where b.item_id % 10 <> d.doc_id % 10) select doc_id, item_id, rn::bigint as rank from r where rn <= 3""",
)
def negative_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = load(spark, sf_dir, "benchmark").select("item_id")
    return packing.negatives(documents(spark, sf_dir), pool, "doc_id", "item_id", lambda d, b: F.col(b) % 10 != F.col(d) % 10, 3)
