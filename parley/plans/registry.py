"""Queries of the engine's own operators by name, each with the SQL that an independent engine runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register the decorated function under ``name``."""

    def keep(function: Callable) -> Callable:
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return keep


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from parley.plans import agents, conversations, datasets, encoding, inventory, losses, more, objects, recipes, relational, sampling, scoring, sources, training  # noqa: E402, F401
