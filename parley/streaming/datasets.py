"""Dataset algebra on streams: take and skip, shuffling, interleaving and stateless maps, each batch written once.

A stream has no rows to count, so what depends on how many came before is kept with the results: each
batch's folder tells how many rows it was given, and a batch that is repeated replaces its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.algebra import numbered
from parley.sources.readers import write_batch, written_batches


def seen_before(df: DataFrame, counts: str, batch: int) -> int:
    """Rows of the batches before this one, by the counts that are written with them."""
    spark = df.sparkSession
    if not any(b < batch for b in written_batches(spark, counts)):
        return 0
    return spark.read.parquet(counts).where(F.col("batch") < batch).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def sliced(stream: DataFrame, path: str, checkpoint: str, order: str, skip: int = 0, take: int | None = None):
    """Start writing the stream's rows from the ``skip``-th on, at most ``take`` of them, in order of arrival and ``order`` within a batch."""
    counts = f"{path}-counts"

    def write(df: DataFrame, batch: int) -> None:
        before = seen_before(df, counts, batch)
        rows = numbered(df, [order], "place").withColumn("place", F.col("place") + before)
        kept = rows.where(F.col("place") >= skip)
        write_batch(kept if take is None else kept.where(F.col("place") < skip + take), path, batch)
        write_batch(df.agg(F.count("*").alias("n")), counts, batch)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def shuffled(stream: DataFrame, path: str, checkpoint: str, key: str, buffer: int = 1000, seed: int = 42):
    """Start writing the stream in a random but repeatable order: batches fall into buffers of so many rows, each in order of a hash."""

    def write(df: DataFrame, batch: int) -> None:
        rows = numbered(df, [key], "_n").withColumn("buffer", F.floor(F.col("_n") / buffer))
        hashed = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
        write_batch(numbered(rows.withColumn("_h", hashed), ["buffer", "_h", key], "place").drop("_n", "_h"), path, batch)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def interleaved(streams: list[DataFrame], tag: str = "stream") -> DataFrame:
    """Rows of several streams as they come, each with its stream's number; columns are matched by name."""
    if not streams:
        raise ValueError("no streams")
    out = None
    for i, s in enumerate(streams):
        s = s.withColumn(tag, F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    return out


def mapped(stream: DataFrame, preprocess: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The stream through a stateless preprocessor; what needs all rows, such as an exact split, raises before it starts."""
    return preprocess(stream)


def split(stream: DataFrame, ratio: float, n: int | None = None) -> None:
    """A stream can be split only if it is known how many rows to take; otherwise this raises."""
    if 0 < ratio < 1 and n is None:
        raise ValueError("a stream's split needs the number of rows")
