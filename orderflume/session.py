"""Session settings the engine is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sides that fit a task's memory are hashed instead of sorted; larger ones still sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    # Surrogate ids written as unsigned 32-bit and ids written as bigint scan alike.
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # A whole run compiles several hundred stages; keep them for the next one.
    "spark.sql.codegen.cache.maxEntries": "1000",
}


def build_session(app: str = "orderflume", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``master`` is left to spark-submit when None.

    Shuffle width is not pinned here: give the cluster a high
    ``spark.sql.shuffle.partitions`` and adaptive execution merges what is small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
