"""Dataset algebra: sampling, splitting, sharding, batching, interleaving and deduplication with exact counts.

Rows have no order of their own in Spark, so every operator takes the column that orders them; random
choices follow a hash of the seed and that column, which any engine can repeat. Row numbers over a
whole table come from counts per range partition, which are written once, never from one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.sources.scratch import folder


def hash_order(key: str, seed: int = 42) -> Column:
    """A random but repeatable order: the md5 of the key and the seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))


def numbered(df: DataFrame, order: list[Column | str], name: str = "rn") -> DataFrame:
    """Row numbers from 0 in a global order, in two passes over range partitions: each partition's count gives the next one's offset.

    The sorted partitions are written once and both passes read them. Bounds are sampled, and small partitions put together by
    their bytes, anew whenever a range exchange runs, so two runs of it would count other partitions than they number.
    """
    spark, path = df.sparkSession, folder(df.sparkSession, "numbered")
    # partition and place in it: the upper 31 and the lower 33 bits
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    parts.write.parquet(path)
    parts = spark.read.schema(parts.schema).parquet(path)
    part = F.shiftright("__at", 33)
    counts = parts.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    # a row per partition
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__p", before.alias("__offset"))
    joined = parts.join(F.broadcast(offsets), part == F.col("__p"))
    place = F.col("__at").bitwiseAND(F.lit(2**33 - 1))
    return joined.withColumn(name, (F.col("__offset") + place).cast("long")).drop("__at", "__p", "__offset")


def sample(df: DataFrame, n: int | None, key: str, shuffle: bool = True, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows with their ``copy`` number from 0: as many whole copies as fit, then a choice of the rest. ``n`` of None or the row count keeps all rows once."""
    total = df.count()
    if n is None or n == total:
        return df.withColumn("copy", F.lit(0).cast("long"))
    if total == 0 or n < 0:
        raise ValueError("cannot sample from no rows, or fewer than none")
    whole, rest = divmod(n, total)
    order = hash_order(key, seed) if shuffle else F.col(key)
    # the rest is a bounded top-n of keys, which Spark takes without a full sort
    extra = df.orderBy(order, key).limit(rest).withColumn("copy", F.lit(whole).cast("long"))
    if not whole:
        return extra
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(whole - 1)).cast("array<bigint>"))).unionByName(extra)


def split(df: DataFrame, ratio: float, key: str, seed: int = 42) -> DataFrame:
    """``df`` with ``part``: 'val' for exactly max(int(rows * ratio), 1) rows in hash order, else 'train'; a ratio of 0 or 1 names all rows alike."""
    if ratio in (0, 1):
        return df.withColumn("part", F.lit("val" if ratio else "train"))
    held = max(int(df.count() * ratio), 1)
    val = df.orderBy(hash_order(key, seed), key).limit(held).select(F.col(key).alias("__key"), F.lit(True).alias("__val"))
    out = df.join(val, df[key] == val["__key"], "left")
    return out.withColumn("part", F.when(F.col("__val"), "val").otherwise("train")).drop("__key", "__val")


def data_range(df: DataFrame, index: int, total: int, key: str) -> DataFrame:
    """Shard ``index`` of ``total`` equal ones in key order; the remainder belongs to none."""
    piece = df.count() // total
    return numbered(df, [key]).where((F.col("rn") >= piece * index) & (F.col("rn") < piece * (index + 1))).drop("rn")


def linspace_shard(df: DataFrame, total: int, key: str, name: str = "shard") -> DataFrame:
    """Contiguous shards in key order with bounds int(i * rows / total), none of the rows left out."""
    rows = df.count()
    found = F.floor((F.col("rn") * total + total - 1) / F.lit(max(rows, 1))).cast("long")
    shard = F.when(F.col("rn") < F.floor(found * rows / F.lit(total)), found - 1).otherwise(found)
    return numbered(df, [key]).withColumn(name, F.least(shard, F.lit(total - 1)).cast("long")).drop("rn")


def rank_batches(df: DataFrame, world: int, batch: int, key: str, seed: int = 42, drop_last: bool = True) -> DataFrame:
    """``rank`` and ``batch`` of each row: rows in hash order are dealt in strides to ranks, whose shares are cut into batches; what makes no whole share or batch is dropped."""
    share = df.count() // world
    rows = numbered(df, [hash_order(key, seed), F.col(key)]).where(F.col("rn") < share * world)
    rows = rows.withColumn("rank", F.pmod("rn", F.lit(world))).withColumn("batch", F.floor(F.floor(F.col("rn") / world) / batch))
    if drop_last:
        rows = rows.where(F.col("batch") < share // batch)
    return rows.drop("rn")


def interleave(df: DataFrame, source: str, key: str, order: list[str], stop: str = "first_exhausted", limit: int | None = None) -> DataFrame:
    """Rows of the sources in the repeating order given, with their ``slot``.

    ``first_exhausted`` ends with the first source that has no next row; ``all_exhausted`` goes on until
    each has given all its rows, and starts the short ones again.
    """
    counts = {r[source]: r["n"] for r in df.where(F.col(source).isin(order)).groupBy(source).agg(F.count("*").alias("n")).collect()}
    turns: dict[str, list[int]] = {}
    for i, name in enumerate(order):
        turns.setdefault(name, []).append(i)
    ends = []
    for name, at in turns.items():
        n, per = counts.get(name, 0), len(at)
        ends.append((n // per) * len(order) + at[n % per])
    slots = min(ends) if stop == "first_exhausted" else max(ends)
    if limit is not None:
        slots = min(slots, limit)
    spark = df.sparkSession
    names = F.array(*[F.lit(n) for n in order])
    seen = F.array(*[F.lit(order[:i].count(n)) for i, n in enumerate(order)])
    per = F.array(*[F.lit(len(turns[n])) for n in order])
    size = F.array(*[F.lit(max(counts.get(n, 0), 1)) for n in order])
    at = F.pmod("slot", F.lit(len(order))).cast("int")
    plan = spark.range(slots).select(F.col("id").alias("slot")).select(
        "slot", F.get(names, at).alias("__s"), F.pmod(F.floor(F.col("slot") / len(order)) * F.get(per, at) + F.get(seen, at), F.get(size, at)).alias("__k")
    )
    ranked = numbered_by(df.where(F.col(source).isin(order)), source, key)
    return ranked.join(plan, (F.col(source) == F.col("__s")) & (F.col("__rn") == F.col("__k"))).drop("__s", "__k", "__rn")


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key, that with the greatest ``order``: an aggregate with map-side combine and no window."""
    rest = [c for c in df.columns if c not in (key, order)]
    last = df.groupBy(key).agg(F.max(F.struct(F.col(order), *rest)).alias("__last"))
    return last.select(key, *[F.col("__last")[c].alias(c) for c in (order, *rest)])


def concat(*frames: DataFrame | None) -> DataFrame | None:
    """All rows of the frames that there are, columns matched by name; None of none."""
    found = [f for f in frames if f is not None]
    out = found[0] if found else None
    for f in found[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def length_batches(df: DataFrame, length: str, key: str, batch: int, mega: int = 50, seed: int = 42) -> DataFrame:
    """``batch`` numbers that group rows of like length: rows in hash order fall into groups of ``batch * mega``, each sorted by length.

    A null key comes last in the hash order and among rows of one length, as a null length does in its group.
    """
    rows = numbered(df, [hash_order(key, seed).asc_nulls_last(), F.asc_nulls_last(key)]).withColumn("__mega", F.floor(F.col("rn") / (batch * mega)))
    place = F.row_number().over(Window.partitionBy("__mega").orderBy(F.desc_nulls_last(length), F.asc_nulls_last(key))) - 1
    return rows.withColumn("batch", F.col("__mega") * mega + F.floor(place / batch)).drop("rn", "__mega")


def split_in_order(df: DataFrame, n: int, ratio: float, key: str) -> DataFrame:
    """The first ``n`` rows in key order with ``part``: the first int(n * ratio) are 'val', the others 'train'; nothing is shuffled."""
    held = int(n * ratio)
    taken = df.orderBy(key).limit(n)
    if not held:
        return taken.withColumn("part", F.lit("train"))
    border = taken.orderBy(key).limit(held).agg(F.max(key).alias("__border"))  # one row
    return taken.join(F.broadcast(border)).withColumn("part", F.when(F.col(key) <= F.col("__border"), "val").otherwise("train")).drop("__border")


def batches(df: DataFrame, size: int, key: str, name: str = "batch") -> DataFrame:
    """Whole batches of consecutive rows in key order; what makes no whole one is left out."""
    whole = df.count() // size
    return numbered(df, [key]).where(F.col("rn") < whole * size).withColumn(name, F.floor(F.col("rn") / size)).drop("rn")


def strided_shard(df: DataFrame, total: int, key: str, name: str = "shard") -> DataFrame:
    """Rows dealt in turn to ``total`` shards, in key order."""
    return numbered(df, [key]).withColumn(name, F.pmod("rn", F.lit(total))).drop("rn")


def epochs(df: DataFrame, n: int, key: str, name: str = "epoch") -> DataFrame:
    """All rows ``n`` times, with the number of the round and the place in all rounds."""
    total = df.count()
    rounds = numbered(df, [key]).withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>")))
    return rounds.withColumn("place", F.col("rn") + F.col(name) * total).drop("rn")


def drawn(df: DataFrame, source: str, key: str, probabilities: dict[str, float], seed: int = 42, stop: str = "first_exhausted") -> DataFrame:
    """Rows of sources drawn slot by slot with the given probabilities, each source's in key order, with their ``slot``.

    Slot k's source comes from a hash of seed and slot, so every engine draws the same. ``first_exhausted``
    ends before the first slot whose source has no next row; ``all_exhausted`` ends when each source has
    given all its rows, and starts the short ones again. Sources without rows or chance are left out.
    """
    if stop not in ("first_exhausted", "all_exhausted"):
        raise ValueError(f"unknown stop {stop!r}")
    found = df.where(F.col(source).isin([s for s, p in probabilities.items() if p > 0]))
    counts = {r[0]: r[1] for r in found.groupBy(source).agg(F.count("*")).collect()}
    names = [s for s in probabilities if counts.get(s)]
    if not names:
        return df.limit(0).withColumn("slot", F.lit(0).cast("long"))
    total = sum(probabilities[s] for s in names)
    # as many slots as the slowest source may need, with room for chance; more are drawn if they do not do
    need = max(counts[s] / probabilities[s] for s in names) * total if stop == "all_exhausted" else min(counts[s] / probabilities[s] for s in names) * total
    slots = int(need + 8 * need**0.5 + 64)
    while True:
        plan = _drawn_plan(df, source, names, [probabilities[s] / total for s in names], slots, seed)
        last = {r[0]: r[1] for r in plan.join(F.broadcast(_sizes(df, counts, stop)), F.col("__s") == F.col("__name")).where("__k = __want").groupBy("__s").agg(F.min("slot")).collect()}
        if stop == "first_exhausted" and last or len(last) == len(names):
            break
        slots *= 2
    end = min(last.values()) - 1 if stop == "first_exhausted" else max(last.values())
    size = F.element_at(F.create_map(*[x for s in names for x in (F.lit(s), F.lit(counts[s]))]), F.col("__s"))
    plan = plan.where(F.col("slot") <= end).withColumn("__k", F.pmod("__k", size))
    ranked = numbered_by(found, source, key)
    return ranked.join(plan, (F.col(source) == F.col("__s")) & (F.col("__rn") == F.col("__k"))).drop("__s", "__k", "__rn")


def _drawn_plan(df: DataFrame, source: str, names: list[str], shares: list[float], slots: int, seed: int) -> DataFrame:
    """``slot, __s, __k``: the source of each slot, and how often it was drawn before."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary")), 1, 13)
    unit = F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))
    name, edge = F.lit(names[-1]), 1.0
    for s, share in zip(reversed(names[:-1]), reversed(shares[1:]), strict=True):
        edge -= share
        name = F.when(unit < F.lit(edge), F.lit(s)).otherwise(name)
    return numbered_by(df.sparkSession.range(slots).select(F.col("id").alias("slot"), name.alias("__s")), "__s", "slot").withColumnRenamed("__rn", "__k")


def _sizes(df: DataFrame, counts: dict[str, int], stop: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(s, n if stop == "first_exhausted" else n - 1) for s, n in counts.items()], "__name string, __want long")


def numbered_by(df: DataFrame, group: str, key: str, name: str = "__rn") -> DataFrame:
    """Row numbers from 0 within each group in key order; a large group's rows lie in many range partitions, none in one task alone."""
    rows = numbered(df, [F.col(group), F.col(key)], "__all")
    first = rows.groupBy(group).agg(F.min("__all").alias("__first"))
    return rows.join(F.broadcast(first), group).withColumn(name, F.col("__all") - F.col("__first")).drop("__all", "__first")
