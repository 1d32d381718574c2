"""Session defaults and input-driven sizing."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import SparkSession

KB = 1024
MB = 1024 * KB
TB = 1024 * 1024 * MB

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    "spark.sql.parquet.compression.codec": "zstd",
}


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Split size and shuffle width for an input of ``input_bytes`` on ``cores``.

    The blocks of a shuffle are map tasks times partitions, and the driver keeps track of all of
    them, so tasks grow with the square root of the input, and their number does too: 128 MB
    up to 1 TB, about 1.3 GB in 84,000 tasks at 100 TB, sorted by spilling. Adaptive
    execution merges partitions that turn out small.
    """
    part = max(128 * MB, isqrt(input_bytes * 16 * KB))
    return {
        "spark.sql.files.maxPartitionBytes": str(part),
        "spark.sql.shuffle.partitions": str(max(cores, -(-input_bytes // part))),
    }


def build_session(app_name: str, extra: dict[str, str] | None = None) -> SparkSession:
    """Session with ``DEFAULTS``; the master and the shared folder come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app_name: str, cores: int, extra: dict[str, str] | None = None) -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    local = {
        "spark.master": f"local[{cores}]",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
    }
    return build_session(app_name, {**local, **(extra or {})})
