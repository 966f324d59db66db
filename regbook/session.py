"""Session defaults the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def registry_session(app_name: str = "regbook", **conf: str) -> SparkSession:
    """A session with adaptive execution on; cluster settings still win through
    ``spark-submit`` for anything not named here."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
