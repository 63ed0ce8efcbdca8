"""A session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, name: str = "lakebind") -> SparkSession:
    """A session with AQE, skew-join handling and Arrow transfer on; ``master`` None leaves it to spark-submit."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
