"""Replacement and negative sampling with repeatable choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.operators.algebra import hash_order, numbered


def replaced(df: DataFrame, failed: Column, key: str, seed: int = 42) -> DataFrame:
    """As many rows as before: each failed row, numbered in key order, takes the place-th good row in hash order, starting over at the end; ``slot`` is the key whose place a row fills."""
    good, bad = df.where(~failed), df.where(failed).select(F.col(key).alias("slot"))
    n = good.count()
    if n == 0:
        raise ValueError("no row is left to draw from")
    drawn = numbered(good, [hash_order(key, seed), F.col(key)], "__k")
    wanted = numbered(bad, ["slot"], "__i").withColumn("__k", F.pmod("__i", F.lit(n))).drop("__i")
    return good.withColumn("slot", F.col(key)).unionByName(drawn.join(wanted, "__k").drop("__k"))


def refilled(df: DataFrame, valid: Column, required: int, key: str, rounds: int = 10) -> DataFrame:
    """The first ``required`` valid rows in key order, out of at most ``required * (rounds + 1)`` attempts; too few raise."""
    tried = df.orderBy(key).limit(required * (rounds + 1)).where(valid)
    out = tried.orderBy(key).limit(required)
    if out.count() < required:
        raise ValueError(f"fewer than {required} valid rows in {required * (rounds + 1)} attempts")
    return out


def fixed_negatives(negatives: Column, pool: Column, n: int, key: Column, seed: int = 42) -> Column:
    """Exactly ``n`` negatives: the first of too many; too few are topped up from the pool by hash, with repeats. An empty pool tops nothing up."""
    lack = F.greatest(F.lit(n) - F.size(negatives), F.lit(0))
    spots = F.when(lack > 0, F.sequence(F.lit(1), lack)).otherwise(F.array().cast("array<int>"))
    more = F.transform(spots, lambda i: F.get(pool, F.pmod(F.xxhash64(F.lit(seed), key, i), F.greatest(F.size(pool), F.lit(1))).cast("int")))
    return F.concat(F.slice(negatives, F.lit(1), F.lit(n)), F.filter(more, lambda x: x.isNotNull()))


def ranked_candidates(df: DataFrame, query: str, label: str, key: str, positives: int = 1, negatives: int = 7, seed: int = 42) -> DataFrame:
    """At most so many positives of each query, each with so many negatives of its own draw: ``group, query, key, label``.

    Draws go by hash of the group and the candidate, ranked within the query's own candidates.
    """
    order = Window.partitionBy(query).orderBy(hash_order(key, seed), key)
    anchors = df.where(F.col(label) == 1).withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= positives)
    anchors = anchors.select(F.col(query).alias("__q"), F.col(key).alias("group"))
    pairs = df.where(F.col(label) == 0).join(anchors, F.col(query) == F.col("__q")).drop("__q")
    draw = Window.partitionBy("group").orderBy(F.md5(F.concat_ws(":", "group", key, F.lit(seed)).cast("binary")), key)
    drawn = pairs.withColumn("__r", F.row_number().over(draw)).where(F.col("__r") <= negatives)
    own = df.join(anchors, (F.col(query) == F.col("__q")) & (F.col(key) == F.col("group"))).drop("__q")
    return own.unionByName(drawn.drop("__r")).select("group", query, key, label)


def shuffled_buffers(df: DataFrame, order: list[str], key: str, size: int = 1000, seed: int = 42) -> DataFrame:
    """``place`` of each row when only runs of ``size`` consecutive rows are shuffled, as a stream's buffer does."""
    rows = numbered(df, order, "__rn").withColumn("__run", F.floor(F.col("__rn") / size))
    inside = F.row_number().over(Window.partitionBy("__run").orderBy(hash_order(key, seed), key)) - 1
    return rows.withColumn("place", (F.col("__run") * size + inside).cast("long")).drop("__rn", "__run")


def replaced_within(df: DataFrame, failed: Column, key: str, tries: int = 10, seed: int = 42) -> DataFrame:
    """The same with a limit: the i-th failed row looks at ``tries`` places of its own in a fixed order of all rows and takes the first good one; a row that finds none raises.

    ``slot`` is the key whose place a row fills.
    """
    total = df.count()
    order = numbered(df.withColumn("__bad", failed), [hash_order(key, seed), F.col(key)], "__k")
    bad = numbered(df.where(failed).select(F.col(key).alias("slot")), ["slot"], "__i")
    places = bad.select("slot", F.posexplode(F.sequence(F.lit(0), F.lit(tries - 1))).alias("__try", "__t"), F.col("__i")).withColumn("__k", F.pmod(F.col("__i") * tries + F.col("__t"), F.lit(max(total, 1))))
    found = places.join(order.where(~F.col("__bad")), "__k")
    first = found.groupBy("slot").agg(F.min("__try").alias("__try"))
    if first.count() < bad.count():
        raise ValueError(f"a row found no replacement in {tries} tries")
    taken = found.join(first, ["slot", "__try"]).select(*df.columns, "slot")
    return df.where(~failed).withColumn("slot", F.col(key)).unionByName(taken)
