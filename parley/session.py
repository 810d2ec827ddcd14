"""A session with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", name: str = "parley", **settings: str) -> SparkSession:
    """AQE with skew joins and coalescing, and UTC; further settings by name, with '__' for dots."""
    builder = SparkSession.builder.master(master).appName(name)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
