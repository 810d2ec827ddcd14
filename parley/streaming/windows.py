"""Event-time operators: the same functions serve batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def late(df: DataFrame, watermark: str | None, time: str = "ts") -> DataFrame:
    """A stream with a watermark; batch data, and streams with none asked for, as they are."""
    return df.withWatermark(time, watermark) if watermark and df.isStreaming else df


def counts(df: DataFrame, width: str, slide: str | None, by: list[str | Column], watermark: str | None = None, time: str = "ts") -> DataFrame:
    """``start`` of each tumbling or sliding window, and its rows by key."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = late(df, watermark, time).groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"))
    return grouped.select(F.col("w.start").alias("start"), *by, "n")


def sessions(df: DataFrame, key: str, gap: str, watermark: str | None = None, time: str = "ts") -> DataFrame:
    """``start`` and rows of each session of a key; a pause of ``gap`` or more ends one."""
    grouped = late(df, watermark, time).groupBy(F.col(key), F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"))
    return grouped.select(key, F.col("w.start").alias("start"), "n")


def distinct(df: DataFrame, keys: list[str], watermark: str, time: str = "ts") -> DataFrame:
    """The first row of each key; a stream forgets a key when the watermark has passed it."""
    return late(df, watermark, time).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def read(spark: SparkSession, path: str, schema, format: str = "parquet", files_per_trigger: int = 16) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(format).load(path)


def write(df: DataFrame, path: str, checkpoint: str, format: str = "parquet", mode: str = "append"):
    """Start writing a stream to files, each batch exactly once; ends when all that is there now is written."""
    return df.writeStream.format(format).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
