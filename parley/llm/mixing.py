"""Mixing sources to target weights by Poisson replication.

A source with ``n`` of all ``N`` documents and target share ``w`` has the mean repetition rate
``w * N / n``. Each document draws a uniform number from a hash of the seed and its id, inverts the
Poisson distribution function at it, is exploded by the resulting count, and all copies are dealt
out and ordered by a second hash. Draws depend on nothing but seed, id and rate, so a lost task
repeats the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.bind import bound
from parley.llm.common import held, joined, unpacked

#: Up to so many sources the rate table (a name and an array of doubles each) is broadcast; beyond, it is joined.
BROADCAST_SOURCES = 4096
#: Mean up to which a rate table is broadcast: bounds the length of its arrays.
BROADCAST_RATE = 64.0
SEED = 42
TAIL = 1e-16


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 13 hexadecimal digits of md5('seed:key')."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def rates(sources: DataFrame, weights: dict[str, float] | None, default_weight: float) -> DataFrame:
    """One row per ``source`` of a table's rows: its mean repetition ``rate``, from documents and share of the target."""
    counts = sources.groupBy("source").agg(F.count("*").alias("n"))
    weight = F.lit(float(default_weight))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    counts = counts.withColumn("w", weight)
    totals = counts.agg(F.sum("w").alias("tw"), F.sum("n").alias("tn"))
    return counts.join(F.broadcast(totals)).select("source", (F.col("w") / F.col("tw") * F.col("tn") / F.col("n")).alias("rate"))  # the right side is one row


def distribution(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the upper tail is below what a draw can resolve; sums of exp(log pmf), so no large rate underflows."""
    last = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(30.0)).cast("int")
    start = F.struct(
        F.array(F.exp(-rate)).alias("cdf"), F.exp(-rate).alias("sum"), (-rate).alias("log")
    )

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = acc["sum"] + F.exp(log)
        return F.struct(F.concat(acc["cdf"], F.array(total)).alias("cdf"), total.alias("sum"), log.alias("log"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"]).otherwise(F.array(F.lit(1.0)))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    default_weight: float = 1.0,
    seed: int = SEED,
    shuffle: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Every document repeated as often as its draw says, in a global order of its own.

    ``weights`` gives target weights of sources, ``default_weight`` that of all others; they need no
    common scale. Returns the columns of ``docs`` plus ``copy`` (int, from 1) and ``rate`` (double);
    existing columns of these names are replaced. A null source is a source of its own, the same as
    the empty name; a null id draws as the empty text; rows that repeat an id get the same count; a
    weight of 0 leaves a source out; an empty table gives an empty result; other columns may have any names. Texts are never looked at.
    """
    if default_weight < 0 or any(w < 0 for w in (weights or {}).values()):
        raise ValueError("weights must not be negative")
    kept = [c for c in docs.columns if c.lower() not in ("copy", "rate")]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce("source", F.lit("")).alias("source"), key.alias("key"), held(docs, kept).alias("doc"))
    table = rates(rows.select("source"), weights, default_weight)
    few = table.agg(F.count("*"), F.max("rate")).first()
    small = few[0] <= BROADCAST_SOURCES and (few[1] or 0.0) <= BROADCAST_RATE
    table = table.withColumn("cdf", distribution(F.col("rate")))
    met = rows.join(F.broadcast(table), "source") if small else joined(rows, table, ["source"])
    # The number of k with P(X <= k) <= draw is the smallest k whose P exceeds it.
    counted = bound(uniform(F.col("key"), seed), lambda u: F.size(F.filter("cdf", lambda p: p <= u)))
    copies = bound(counted, lambda k: F.when(k > 0, F.sequence(F.lit(1), k)))
    out = met.select("key", "doc", F.explode(copies).alias("copy"), "rate")
    if shuffle:
        out = out.select(F.xxhash64(F.lit(seed), "key", "copy").alias("order"), "doc", "copy", "rate")
        dealt = out.repartition(partitions, "order") if partitions else out.repartition("order")
        out = dealt.sortWithinPartitions("order")
    return out.select(*unpacked("doc", kept), "copy", "rate")


#: The same with equal weights; ``{docs}`` is the input.
MIX_SQL = """
with src as (select coalesce(source, '') s, count(*) n from {docs} group by 1),
rate as (select s, 1.0::double / (select count(*) from src)::double * (select sum(n) from src)::double / n::double r from src),
pmf as (select s, k, exp(-r + k * ln(r) - lgamma(k + 1)) p from rate, (select unnest(range(0, 200)) k)),
cdf as (select s, k, sum(p) over (partition by s order by k) c from pmf),
draw as (select distinct doc_id, coalesce(source, '') s,
  (('0x' || substr(md5('42:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 u from {docs}),
cnt as (select w.doc_id, w.s, count(c.k) n from draw w join cdf c on c.s = w.s and c.c <= w.u group by all),
mixed as (select d.*, unnest(range(1, n + 1))::integer copy from {docs} d
  join cnt on cnt.doc_id is not distinct from d.doc_id and cnt.s = coalesce(d.source, ''))
"""
