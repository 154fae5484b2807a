"""Delivered CSV files as a stream: every new file becomes a raw delta, once."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderflume.model import TABLES
from orderflume.sources import storage

DELTA = "delta_name"


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def stream_deliveries(
    spark: SparkSession,
    landing: str,
    table: str,
    base: str,
    columns: list[str] | None = None,
) -> StreamingQuery:
    """Take over all files (or directories of part files) ``<table>_<name>.csv`` that have
    arrived since the last call, then stop.

    The delta is named after all that stands before ``.csv``. Parts of a delta that arrive later
    join the earlier ones. Each micro-batch is written once, split by delta, and its files are
    named after the batch when they move to the raw zone, so a batch repeated after a failure
    replaces its own files and no others. The checkpoint under ``base`` remembers what was taken.
    ``columns`` names the file's columns when they are more than the declared ones.
    """
    schema = text_schema(columns or TABLES[table].required)
    name = F.regexp_extract(F.col("_metadata.file_path"), rf"/({table}_[^/]*)\.csv(?:/|$)", 1)
    # Directories are listed with their parts; a header that differs from the schema fails.
    files = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(f"{landing}/{table}_*.csv")
        .withColumn(
            DELTA, F.when(name != "", name).otherwise(F.raise_error(F.lit("a delivered file has no delta name")))
        )
    )

    def land(batch: DataFrame, number: int) -> None:
        pending = f"{base}/status/landing_{table}/{number}"
        batch.write.partitionBy(DELTA).mode("overwrite").parquet(pending)
        # names of files only: a handful per delta, never rows
        for folder, _ in storage.entries(spark, pending):
            delta = unquote(folder.partition("=")[2])
            target, mark = f"{base}/raw/{delta}.parquet", f"batch-{number:09d}-"
            for old, _ in storage.entries(spark, target):
                if old.startswith(mark):
                    storage.remove_directory(spark, f"{target}/{old}")
            for part, _ in storage.entries(spark, f"{pending}/{folder}"):
                storage.move_file(spark, f"{pending}/{folder}/{part}", f"{target}/{mark}{part}")
        storage.remove_directory(spark, pending)

    return (
        files.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{base}/status/stream_{table}")
        .trigger(availableNow=True)
        .start()
    )
