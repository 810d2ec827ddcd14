"""Packing, chunking and batch shaping of sequences by length."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from parley.functions.bind import bound
from parley.operators.algebra import numbered

#: Rows of a shard that is packed in one go, and pool items that a query's negatives are drawn from at once.
SHARD_ROWS, POOL_ROWS = 100_000, 10_000


def chunks(tokens: Column, size: int) -> Column:
    """Consecutive slices of at most ``size`` tokens; none of an empty array."""

    def of(held: Column) -> Column:
        starts = F.when(F.size(held) > 0, F.sequence(F.lit(1), F.size(held), F.lit(size))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.slice(held, i, F.lit(size)))

    return bound(tokens, of)


def truncated(tokens: Column, size: int, side: str = "right") -> Column:
    """At most ``size`` tokens; ``side`` is where the others are cut off."""
    if side == "right":
        return F.slice(tokens, F.lit(1), F.lit(size))
    return F.slice(tokens, F.greatest(F.size(tokens) - size + 1, F.lit(1)), F.lit(size))


def closes(used: float, n: float, capacity: int) -> bool:
    """Whether the open pack is closed before a row of length ``n``."""
    return used >= capacity or used + n > capacity


def transitions(lengths: list, capacity: int) -> list[tuple]:
    """What a shard makes of any open pack: ``least, packs, used``, the first that fits counts.

    A pack that holds ``least`` or more is closed in the shard, which starts ``packs`` packs, the last of which holds
    ``used``; without a ``least`` it is not closed, and ``used`` is added to it.
    """
    n = len(lengths)
    ends: dict[int, tuple] = {n: (0, None)}

    def end(start: int) -> tuple:
        path = []
        while start not in ends:
            used, i = lengths[start], start + 1
            while i < n and not closes(used, lengths[i], capacity):
                used, i = used + lengths[i], i + 1
            path.append((start, i, used))
            start = i
        for start, i, used in reversed(path):
            packs, last = ends[i]
            ends[start] = (packs + 1, used if last is None else last)
        return ends[path[0][0]] if path else ends[start]

    out, before, low = [], 0, None
    for i, length in enumerate(lengths):
        least = capacity - before - max(0, length - 1)
        if low is None or least < low:
            low = least
            out.append((float(least), *end(i)))
            if low <= 0:
                return out
        before += length
    return [*out, (None, 0, before)]


def next_fit(df: DataFrame, length: str, key: str, capacity: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``pack_id`` by next-fit in key order: a pack is closed when it is full or the next row would not fit; a longer row is alone.

    Rows are numbered globally and packed in shards of ``shard_rows`` consecutive rows, so no task's
    state grows with the table. A first pass tells what each shard makes of any open pack, from which the pack that is
    open at each shard's start follows: packs are those of one sequential pass. Lengths are whole numbers from 0.
    """
    rows = numbered(df, [key, length], "__rn").withColumn("__shard", F.floor(F.col("__rn") / shard_rows))

    def told(pdf: pd.DataFrame) -> pd.DataFrame:
        found = transitions(pdf.sort_values("__rn", kind="stable")[length].tolist(), capacity)
        return pd.DataFrame([(pdf["__shard"].iloc[0], i, *x) for i, x in enumerate(found)], columns=["shard", "i", "least", "packs", "used"])

    # at most a row per place in a pack and shard
    found = rows.select("__shard", "__rn", length).groupBy("__shard").applyInPandas(told, "shard long, i long, least double, packs long, used double")
    shards: dict[int, list] = {}
    for r in found.orderBy("shard", "i").toLocalIterator():
        shards.setdefault(r["shard"], []).append(r)
    pack, used, states = -1, float(capacity), []
    for shard, choices in shards.items():
        states.append((shard, pack, used))
        r = next(r for r in choices if r["least"] is None or used >= r["least"])
        pack, used = pack + r["packs"], used + r["used"] if r["least"] is None else r["used"]
    # a row per shard
    states = df.sparkSession.createDataFrame(states, "__s long, __pack long, __used double")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__rn", kind="stable")
        pack, used, out = pdf["__pack"].iloc[0], pdf["__used"].iloc[0], []
        for n in pdf[length].tolist():
            if closes(used, n, capacity):
                pack, used = pack + 1, 0
            used += n
            out.append(pack)
        return pdf.assign(pack_id=out).drop(columns=["__pack", "__used", "__s"])

    joined = rows.join(F.broadcast(states), F.col("__shard") == F.col("__s"))
    return joined.groupBy("__shard").applyInPandas(run, StructType([*rows.schema.fields, StructField("pack_id", LongType())])).drop("__rn", "__shard")


def best_fit(df: DataFrame, length: str, key: str, capacity: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, pack_id, n, total`` of packs by best-fit decreasing within shards of consecutive rows: each row goes to the fullest pack that holds it, longest rows first."""
    rows = numbered(df, [key], "__rn").select(key, length, F.floor(F.col("__rn") / shard_rows).alias("shard"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import bisect

        pdf = pdf.sort_values([length, key], ascending=[False, True])
        space: list[tuple[int, int]] = []  # (room, pack), sorted
        totals: list[int] = []
        counts: list[int] = []
        for n in pdf[length]:
            at = bisect.bisect_left(space, (n, -1))
            if at < len(space):
                room, pack = space.pop(at)
            else:
                room, pack = max(capacity, n), len(totals)
                totals.append(0), counts.append(0)
            totals[pack] += n
            counts[pack] += 1
            bisect.insort(space, (room - n, pack))
        return pd.DataFrame({"shard": pdf["shard"].iloc[0], "pack_id": range(len(totals)), "n": counts, "total": totals})

    return rows.groupBy("shard").applyInPandas(run, "shard long, pack_id long, n long, total long")


def rotate_in_batches(df: DataFrame, value: str, key: str, batch: int, name: str) -> DataFrame:
    """``name`` is the value of the row before, within batches of consecutive rows; the first takes the last one's. A null key comes last."""
    rows = numbered(df, [F.asc_nulls_last(key)], "__rn").withColumn("__batch", F.floor(F.col("__rn") / batch))
    w = Window.partitionBy("__batch").orderBy("__rn")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn(name, F.coalesce(F.lag(value).over(w), F.last(value).over(whole))).drop("__rn", "__batch")


def negatives(queries: DataFrame, pool: DataFrame, key: str, item: str, allowed: Callable[[str, str], Column], n: int) -> DataFrame:
    """``n`` pool items per query in a hash order of their own, with their ``rank``; ``allowed`` says which pairs may be drawn.

    The order is a hash of the pair, so every pair is looked at. A pool of at most POOL_ROWS items is collected once and
    ranked per query in place, without a join; a larger one is joined in slices of so many, each of which leaves ``n`` items.
    """
    items = [r[0] for r in pool.select(item).limit(POOL_ROWS + 1).collect()]
    if len(items) > POOL_ROWS:
        slices = numbered(pool.select(item), [item], "__rn").groupBy(F.floor(F.col("__rn") / POOL_ROWS).alias("__slice"))
        pairs = queries.crossJoin(slices.agg(F.collect_list(F.col(item).cast("long")).alias("__items")))
    else:
        pairs = queries.withColumn("__slice", F.lit(0)).withColumn("__items", F.array(*[F.lit(i).cast("long") for i in items]))
    drawn = F.transform(
        F.col("__items"),
        lambda i: F.struct(F.md5(F.concat(F.col(key).cast("string"), F.lit(":"), i.cast("string")).cast("binary")).alias("h"), i.alias("i")),
    )
    rows = pairs.select(key, "__slice", F.explode(drawn).alias("d")).select(key, "__slice", F.col("d.h").alias("h"), F.col("d.i").alias(item)).where(allowed(key, item))
    first = lambda x: F.slice(F.sort_array(x), 1, n)
    best = rows.groupBy(key, "__slice").agg(first(F.collect_list(F.struct("h", F.col(item).alias("i")))).alias("best"))
    best = best.groupBy(key).agg(first(F.flatten(F.collect_list("best"))).alias("best"))
    return best.select(key, F.posexplode("best").alias("p", "x")).select(key, F.col("x.i").alias(item), (F.col("p") + 1).cast("long").alias("rank"))


def row_length(lengths: Column, packed: bool = True) -> Column:
    """Length of a row of several sequences: their sum where they are packed one after another, the greatest where they are filtered."""
    held = F.coalesce(lengths, F.array().cast("array<bigint>"))
    total = F.aggregate(held, F.lit(0).cast("long"), lambda acc, n: acc + n)
    return total if packed else F.coalesce(F.array_max(held).cast("long"), F.lit(0).cast("long"))


def pack_shards(rows: int, workers: int, window: int = 1000) -> int:
    """Shards of a table that is packed by several workers: one for each window of rows at most."""
    return max(1, min(workers, -(-rows // window)))


def fill(lengths: list[tuple[int, int]], capacity: int) -> list[list[tuple[int, int]]]:
    """Packs of (key, length) by best-fit decreasing, in the order in which they were opened; ties to the smaller key."""
    import bisect

    packs: list[list[tuple[int, int]]] = []
    space: list[tuple[int, int]] = []
    for key, n in sorted(lengths, key=lambda x: (-x[1], x[0])):
        at = bisect.bisect_left(space, (n, -1))
        room, pack = space.pop(at) if at < len(space) else (max(capacity, n), len(packs))
        if pack == len(packs):
            packs.append([])
        packs[pack].append((key, n))
        bisect.insort(space, (room - n, pack))
    return packs


def windowed_fit(df: DataFrame, length: str, key: str, capacity: int, workers: int = 1, window: int = 1000) -> DataFrame:
    """``shard, pack_id`` of each row by best-fit decreasing in windows: the last pack of a window is taken apart and joins the next one.

    Shards are contiguous in key order, as many as ``pack_shards`` says, and packed on their own; results
    depend on their number. A task holds a window and the pack carried over, whatever the shard's size.
    """
    from collections.abc import Iterator

    rows = df.count()
    shards = pack_shards(rows, workers, window)
    placed = numbered(df.select(key, length), [key], "__rn")
    # bounds int(i * rows / shards), as of evenly spaced numbers
    bounds = [int(i * rows / shards) for i in range(shards)]
    shard = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b <= F.col("__rn"))) - 1
    placed = placed.withColumn("shard", shard.cast("long"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, pack, held, fresh = None, 0, [], 0

        def close(last: bool) -> pd.DataFrame:
            nonlocal pack, held, fresh
            packs = fill(held, capacity)
            carried = [] if last or not packs else packs.pop()
            out = [(own, pack + i, k) for i, rows_ in enumerate(packs) for k, _ in rows_]
            pack, held, fresh = pack + len(packs), carried, 0
            return pd.DataFrame(out, columns=["shard", "pack_id", key])

        for frame in frames:
            for s, k, n in frame.itertuples(index=False):
                if s != own:
                    if own is not None:
                        yield close(True)
                    own, pack, held, fresh = s, 0, [], 0
                held.append((k, n))
                fresh += 1
                if fresh == window:
                    yield close(False)
        if own is not None:
            yield close(True)

    kind = dict(df.dtypes)[key]
    dealt = placed.repartition(shards, "shard").sortWithinPartitions("shard", "__rn").select("shard", key, F.coalesce(length, F.lit(0)).cast("long").alias(length))
    return dealt.mapInPandas(run, f"shard long, pack_id long, {key} {kind}")
