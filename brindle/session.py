"""Spark sessions with the settings the engine is tested under."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "brindle", **more: str) -> SparkSession:
    """The running session, or a new one; ``more`` are settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
