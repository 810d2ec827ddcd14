"""Joins that equality alone can't express, made equi-joins by cutting values into bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parley.functions.bind import free


def range_join(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, width: float, how: str = "inner") -> DataFrame:
    """Each point with the ranges that hold it, low <= value < high.

    Both sides are dealt by bins of ``width``: a point lies in one, a range in each that it touches, so
    only what may meet is compared. Choose a width near the usual range; null bounds and values meet nothing.
    """
    bin_ = free("bin", points.columns + ranges.columns)
    at = lambda c: F.floor(c / F.lit(float(width))).cast("long")
    left = points.withColumn(bin_, at(F.col(value)))
    whole = ranges.where(F.col(low) < F.col(high))
    right = whole.withColumn(bin_, F.explode(F.sequence(at(F.col(low)), at(F.col(high)))))
    return left.join(right, (left[bin_] == right[bin_]) & (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high)), how).drop(left[bin_]).drop(right[bin_])


def zipped(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of two tables that carry the same row number, side by side; a number that only one of them has raises when it is read."""
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), key, "full")
    fine = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return both.where(F.when(fine, True).otherwise(F.raise_error(F.concat(F.lit("no partner for row "), F.col(key).cast("string"))).cast("boolean"))).drop("_a", "_b")


def within_batches(df: DataFrame, batch: str, key: str, vector: str, similarity) -> DataFrame:
    """All pairs of different rows of a batch with their similarity, as ``a``, ``b`` and ``score``; batches are what bounds the pairs."""
    one, two = (df.select(batch, F.col(key).alias(k), F.col(vector).alias(f"_{k}")) for k in ("a", "b"))
    return one.join(two, batch).where("a <> b").select(batch, "a", "b", similarity(F.col("_a"), F.col("_b")).alias("score"))


def named(ids: Column, names: list[str]) -> Column:
    """Names of an array of numbers from 0; numbers without a name are null."""
    table = F.array(*map(F.lit, names))
    return F.transform(ids, lambda i: F.get(table, i.cast("int")))


def as_of(df: DataFrame, key: str, time: str, mark: Column, value: str, name: str, width: str = "day") -> DataFrame:
    """``name``: of each row, the ``value`` of its key's last marked row up to its time; of marked rows at one time that with the greatest value.

    Keys are cut into spans of time, so a hot key's rows lie in many tasks: a window looks back within a span,
    and what the spans before have left comes from one row a key and span.
    """
    rows = df.withColumns({"_span": F.date_trunc(width, time), "_mark": mark})
    marked = F.when(F.col("_mark"), F.struct(F.col(time).alias("t"), F.col(value).alias("v")))
    left = rows.groupBy(key, "_span").agg(F.max(marked).alias("_last"))
    before = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = left.select(F.col(key).alias("_key"), F.col("_span").alias("_of"), F.last("_last", ignorenulls=True).over(before).alias("_before"))
    inner = Window.partitionBy(key, "_span").orderBy(time).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("_own", F.max(marked).over(inner))
    out = seen.join(carried, F.col(key).eqNullSafe(F.col("_key")) & F.col("_span").eqNullSafe(F.col("_of")), "left")
    return out.withColumn(name, F.coalesce("_own", "_before")["v"]).drop("_span", "_mark", "_own", "_key", "_of", "_before")
