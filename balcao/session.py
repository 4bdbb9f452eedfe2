"""Session settings used by the jobs and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "balcao", master: str | None = None, **extra: str) -> SparkSession:
    """AQE stays on: it picks join strategies from measured sizes, splits skewed partitions, coalesces small ones."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for chave, valor in extra.items():
        builder = builder.config(chave.replace("__", "."), valor)
    return builder.getOrCreate()
