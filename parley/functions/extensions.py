"""What users add: preprocessors, rewards, metrics and losses by name, functions in Python, and modules that register them.

A column expression is registered as a function of columns and stays in generated code. A Python function
of batches becomes an Arrow user-defined one; its None is null.
"""

from __future__ import annotations

import importlib
import importlib.util
import sys
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import metrics, rewards
from parley.operators import losses, normalize

#: By kind and name; ``register`` adds to them.
KINDS: dict[str, dict[str, Callable]] = {
    "preprocessor": {"auto": normalize.auto_preprocess, "alpaca": normalize.alpaca_preprocess, "messages": normalize.messages_preprocess, "response": normalize.response_preprocess},
    "reward": rewards.REWARDS,
    "metric": metrics.METRICS,
    "loss": losses.LOSSES,
}


def register(kind: str, name: str, exist_ok: bool = False) -> Callable:
    """Decorator: keep a function under a name; one that is taken raises unless it may be replaced."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")

    def keep(function: Callable) -> Callable:
        if name in KINDS[kind] and not exist_ok:
            raise ValueError(f"the {kind} {name!r} exists")
        KINDS[kind][name] = function
        return function

    return keep


def find(kind: str, name: str) -> Callable:
    if name not in KINDS.get(kind, {}):
        raise ValueError(f"no {kind} {name!r}; there are {sorted(KINDS.get(kind, {}))}")
    return KINDS[kind][name]


def load_plugins(paths: list[str]) -> list[str]:
    """Import modules by file or dotted name for what they register; the names that were loaded."""
    out = []
    for path in paths:
        if path.endswith(".py"):
            name = f"plugin_{Path(path).stem}"
            spec = importlib.util.spec_from_file_location(name, path)
            module = importlib.util.module_from_spec(spec)
            sys.modules[name] = module
            spec.loader.exec_module(module)
        else:
            name = importlib.import_module(path).__name__
        out.append(name)
    return out


def python_reward(function: Callable[..., list], *columns: str) -> Column:
    """A user's reward in Python: called with a list of completions, and of each further column by keyword; one number or None a row."""
    names = columns[1:]

    @F.pandas_udf("double")
    def run(frame: pd.DataFrame) -> pd.Series:
        found = function(frame[columns[0]].tolist(), **{n: frame[n].tolist() for n in names})
        if len(found) != len(frame):
            raise ValueError(f"{len(found)} rewards for {len(frame)} completions")
        return pd.Series(found, dtype="float64")

    return run(F.struct(*columns))


def python_metric(function: Callable[..., float]) -> Callable[..., Column]:
    """A user's metric in Python over the values of a group."""

    @F.pandas_udf("double")
    def run(*values: pd.Series) -> float:
        return float(function(*values))

    return run


def reward_columns(df: DataFrame, completion: str, names: list[str]) -> DataFrame:
    """A column for each named reward of the completion."""
    return df.withColumns({name: find("reward", name)(F.col(completion)) for name in names})


def total_scores(df: DataFrame, names: list[str], weights: list[float] | None = None, own: str | None = None, name: str = "total_reward") -> DataFrame:
    """The weighted sum of reward columns, nulls left out, null where all are, and an environment's own reward added to it."""
    weights = weights or [1.0] * len(names)
    parts = [F.coalesce(F.col(n), F.lit(0.0)) * F.lit(float(w)) for n, w in zip(names, weights, strict=True)]
    some = F.coalesce(*[F.col(n) for n in names]).isNotNull()
    total = F.when(some, sum(parts[1:], parts[0]))
    return df.withColumn(name, total if own is None else F.coalesce(total, F.lit(0.0)) + F.coalesce(F.col(own), F.lit(0.0)))


def apply_preprocessor(df: DataFrame, name: str) -> DataFrame:
    """The table through a named preprocessor."""
    return find("preprocessor", name)(df)


def register_table_function(spark: SparkSession, name: str, handler: type, schema: str) -> None:
    """A user's class with ``eval`` as a table function of SQL."""
    spark.udtf.register(name, F.udtf(handler, returnType=schema))
