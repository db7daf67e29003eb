"""A local session for tests, benchmarks and small runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "16g") -> SparkSession:
    """On a cluster use the session it gives; nothing here is needed there."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tracemill")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
