"""Users' loaders as a Spark data source: a function per shard, run on the executors, that yields rows."""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "user_loader"


class Shard(InputPartition):
    """One of the loader's shards."""

    def __init__(self, number: int) -> None:
        self.number = number


class LoaderReader(DataSourceReader):
    def __init__(self, loader: str, shards: int, argument: str, tries: int) -> None:
        self.loader, self.shards, self.argument, self.tries = loader, shards, argument, tries

    def partitions(self) -> list[Shard]:
        return [Shard(i) for i in range(self.shards)]

    def read(self, partition: Shard) -> Iterator[tuple]:
        """Rows of one shard. A loader that fails before its first row is tried again; later the task is, which starts the shard anew."""
        module, _, name = self.loader.partition(":")
        load = getattr(importlib.import_module(module), name)
        for left in range(self.tries - 1, -1, -1):
            rows = iter(load(partition.number, self.shards, self.argument))
            try:
                first = next(rows, None)
            except Exception:
                if not left:
                    raise
                continue
            if first is not None:
                yield first
                yield from rows
            return


class LoaderSource(DataSource):
    """``loader`` ('module:function', importable on the executors) of shard, number of shards and ``path``; the schema is the reader's."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema) -> LoaderReader:
        o = self.options
        return LoaderReader(o["loader"], int(o.get("shards", "1")), o.get("path", ""), int(o.get("tries", "1")))


def load(spark: SparkSession, loader: str, schema: str, shards: int = 1, argument: str = "", tries: int = 3) -> DataFrame:
    """The rows of a user's loader."""
    spark.dataSource.register(LoaderSource)
    reader = spark.read.format(FORMAT).schema(schema).option("loader", loader).option("shards", shards).option("tries", tries)
    return reader.load(argument)


def counted(shard: int, shards: int, argument: str) -> Iterator[tuple]:
    """A loader that counts: the numbers below ``argument`` that fall to the shard."""
    for i in range(shard, int(argument), shards):
        yield i, f"row {i}"
