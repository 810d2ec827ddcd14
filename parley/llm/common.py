"""Shared pieces of the training-data operators: table access, scratch tables, connected components.

Scratch tables live in the folder named by ``spark.checkpoint.dir``, which every executor shares.
Only when that setting is absent and the session is local (unit tests) a local folder is used.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_made: list[tuple[object, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a local one, set here, only where none is configured and there is no cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="parley-")
        spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; removed when the driver ends."""
    if not _made:
        atexit.register(lambda: [remove(s, p) for s, p in list(_made)])
    path = f"{checkpoint_root(spark).rstrip('/')}/parley-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path. A session that has ended already keeps its files."""
    _made[:] = [m for m in _made if m[1] != path]
    if spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Makes Spark delete an execution's shuffle files as soon as it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str, files: int | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and reread it: lineage ends in files that no executor owns.

    Shuffle files of the write go as soon as it is over, since nothing but the table is read again. Where the
    caller knows how large the table can be, ``files`` is the most that it is written in.
    """
    df = df if files is None else df.coalesce(files)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def joined(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with their group's columns; null keys are equal.

    Groups come from an aggregate over ``keys``, and would be joined where it left them, with a hot key's
    rows in one task. The keys as a struct make both sides be dealt anew, so that AQE can split a hot one.
    """
    own = F.struct(*keys)
    key = free("key", rows.columns + groups.columns)
    held = groups.select(own.alias(key), *[F.col(f"`{c}`") for c in groups.columns if c not in keys])
    return rows.withColumn(key, own).join(held, key, how).drop(key)


def free(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def held(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The columns of ``df`` in one struct, so that their names meet no others on the way."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if columns is None else columns)])


def unpacked(struct: str, columns: list[str]) -> list[Column]:
    """The columns that ``held`` has put in the column ``struct``."""
    return [F.col(struct).getField(c).alias(c) for c in columns]


def crc32_of(column: str) -> Column:
    """crc32 of a column written as text; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


#: Rows of a file of a round's links, and files at least.
FILE_ROWS, LEAST_FILES = 200_000, 8


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges`` has the columns ``u`` and ``v`` of one comparable type. Rows with a null and loops are
    ignored, repeated rows count once, an empty table gives an empty result. Returns ``node`` and
    ``component``. Alternates large-star and small-star rounds (each one aggregate with map-side
    combine and one join), so a hub costs no more than its edges; ends when a round changes nothing.
    """
    pairs = (
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    pairs, path = materialize(pairs, name)
    state = _state(pairs)
    while state[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = joined(both, low, ["u"]).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = joined(large, low, ["u"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = small.union(low.select("u", F.col("m").alias("v"))).distinct()
        # rounds have no more rows than the first, whose number is known: few rows take few files
        after, after_path = materialize(after.coalesce(max(LEAST_FILES, state[0] // FILE_ROWS + 1)), name)
        remove(edges.sparkSession, path)
        pairs, path, before = after, after_path, state
        state = _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(pairs: DataFrame) -> tuple:
    """Row count and an order-free digest, enough to see that a round changed nothing."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
