"""Readers and writers of datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from parley.operators import algebra
from parley.operators.normalize import auto_preprocess, rename_columns, standard_columns
from parley.sources.spec import Registry, Spec

# File extensions and the readers they stand for.
FORMATS = {"jsonl": "json", "json": "json", "txt": "text", "csv": "csv", "parquet": "parquet", "orc": "orc"}


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder by its extension. Fields of CSV stay strings, and empty ones empty."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in FORMATS:
        raise ValueError(f"no reader for {path!r}")
    reader = spark.read
    if kind == "csv":
        df = reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        return df.na.fill("", [f.name for f in df.schema if isinstance(f.dataType, StringType)])
    if kind == "json":
        return reader.option("multiLine", True).json(path)
    return reader.format(FORMATS[kind]).load(path)


def listed(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder of any file system that Spark reads; None where there is no such folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target) or not fs.getFileStatus(target).isDirectory():
        return None
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def read_folder(spark: SparkSession, path: str, subset: str | None = None, splits: Sequence[str] = ("train",), tries: int = 1) -> DataFrame:
    """The files of the splits in a folder, or in its folder for the subset, under each other: 'split.ext' or 'split-*.ext'.

    What fails is tried again up to ``tries`` times.
    """
    path = path.rstrip("/")
    for left in range(tries - 1, -1, -1):
        try:
            inner = listed(spark, f"{path}/{subset}") if subset and subset != "default" else None
            base, names = (path, listed(spark, path) or []) if inner is None else (f"{path}/{subset}", inner)
            found = []
            for split in splits:
                for name in names:
                    stem, _, kind = name.rpartition(".")
                    if kind in FORMATS and (stem == split or stem.startswith(f"{split}-")):
                        found.append(read_file(spark, f"{base}/{name}"))
            if not found:
                raise FileNotFoundError(f"no split of {list(splits)} in {base}")
            return algebra.concat(*found)
        except Exception:
            if not left:
                raise
    raise ValueError("tries must be at least 1")


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder of splits, and no table written as a folder with an extension."""
    return path.rstrip("/").rsplit(".", 1)[-1].lower() not in FORMATS and listed(spark, path) is not None


def load_dataset(spark: SparkSession, specs: str | list[str], registry: Registry | None = None, tag: bool = False, key: str = "row_id") -> DataFrame:
    """The rows of one or more specifications as conversations in canonical columns.

    Files are read, renamed and preprocessed as their registration says, else by their columns'
    names; '#n' samples exactly n rows; several datasets are put under each other; ``tag`` adds each
    one's specification as the column ``dataset``. Hubs need a network and are not read here.
    """
    registry = registry or Registry()
    parts = []
    for text in [specs] if isinstance(specs, str) else specs:
        spec = Spec.parse(text)
        dataset = registry.resolve(spec)
        if not dataset.path:
            raise ValueError(f"{text!r} is on a hub, which is not read here")
        frames = []
        for subset in dataset.select(spec.subsets):
            raw = read_folder(spark, dataset.path, subset.subset, subset.split) if is_folder(spark, dataset.path) else read_file(spark, dataset.path)
            raw = rename_columns(raw, dataset.columns)
            prepare = subset.preprocess or dataset.preprocess or auto_preprocess
            frames.append(standard_columns(prepare(raw)))
        df = algebra.concat(*frames)
        if spec.sample is not None:
            numbered = df.withColumn(key, F.xxhash64(*[F.to_json(F.struct(c)) for c in df.columns]))
            df = algebra.sample(numbered, spec.sample, key).drop(key, "copy")
        parts.append(df.withColumn("dataset", F.lit(text)) if tag else df)
    return algebra.concat(*parts)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """Rows as JSON lines, under what is there already; nulls are written, and characters beyond ASCII stay as they are."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_cached(df: DataFrame, path: str, lengths: Column, mode: str = "overwrite") -> None:
    """Rows with their ``lengths`` and the greatest of them, sorted by it in each file, so that a filter on it skips row groups."""
    out = df.withColumn("lengths", lengths).withColumn("max_length", F.array_max("lengths"))
    out.sortWithinPartitions("max_length").write.mode(mode).parquet(path)


def read_cached(spark: SparkSession, path: str, max_length: int | None = None, key: str | None = None) -> DataFrame:
    """Cached rows, those longer than ``max_length`` left in the files; 'path#n' samples n rows, told apart by ``key``."""
    path, mark, n = path.partition("#")
    df = spark.read.parquet(path)
    if "lengths" not in df.columns and "length" in df.columns:
        df = df.withColumn("lengths", F.array("length")).withColumnRenamed("length", "max_length")
    if mark:
        if key is None:
            raise ValueError("a sample needs the key that tells rows apart")
        df = algebra.sample(df, int(n), key).drop("copy")
    return df if max_length is None else df.where(F.col("max_length") <= max_length)


def write_indexed(df: DataFrame, path: str, key: str, mode: str = "overwrite") -> None:
    """Rows in ranges of their key, sorted, so that one is found by the statistics of files and row groups."""
    df.repartitionByRange(key).sortWithinPartitions(key).write.mode(mode).parquet(path)


def read_rows(spark: SparkSession, path: str, key: str, keys: list) -> DataFrame:
    """The rows of a few keys; files and row groups that can't hold them are skipped."""
    return spark.read.parquet(path).where(F.col(key).isin(keys))


def write_batch(df: DataFrame, path: str, batch: int, column: str = "batch") -> None:
    """One batch of results; a batch that is written again replaces itself and no other, so a retry leaves each row once."""
    df.withColumn(column, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def written_batches(spark: SparkSession, path: str, column: str = "batch") -> list[int]:
    """Numbers of the batches that are there, from the folders' names alone."""
    mark = f"{column}="
    return sorted(int(n[len(mark) :]) for n in listed(spark, path) or [] if n.startswith(mark))


def sanitized(value: Column, kind: DataType, key: str = "") -> Column:
    """A value for publication, at any depth: bytes become a mark, and texts under a name that holds '_token' null."""
    if isinstance(kind, BinaryType):
        return F.when(value.isNotNull(), F.lit("<<<bytes>>>"))
    if isinstance(kind, StringType):
        return F.lit(None).cast("string") if "_token" in key else value
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[sanitized(value.getField(f.name), f.dataType, f.name).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: sanitized(x, kind.elementType, key))
    if isinstance(kind, MapType):
        secret = lambda k, v: F.when(~F.contains(k, F.lit("_token")), v) if isinstance(kind.valueType, StringType) else sanitized(v, kind.valueType)
        return F.transform_values(value, secret)
    return value


def sanitized_rows(df: DataFrame) -> DataFrame:
    """All columns ``sanitized``."""
    return df.select(*[sanitized(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema.fields])
