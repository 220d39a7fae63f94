"""Session settings that suit these plans; a cluster's own settings are kept."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "acreflow", **more: str) -> SparkSession:
    """The running session, or a new one with ``DEFAULTS`` and ``more`` (dots written as __)."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in more.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
