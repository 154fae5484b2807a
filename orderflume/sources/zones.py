"""Zone tables partitioned by delta: one directory per table, one partition per delivered day.

A day is replaced by Spark's dynamic partition overwrite: its files are written beside the table and take the place of
that one partition when the whole job has ended, so a run that is killed before leaves the old rows, and other days are
never touched. The driver renames nothing itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.sources import storage

DELTA = "delta_date"
_DATED = re.compile(r"([0-9]{4})[_-]([0-9]{2})[_-]([0-9]{2})$")


def delta_date(stem: str, otherwise: str) -> str:
    """ISO date at the end of a delta's name; ``otherwise`` for a name without one."""
    found = _DATED.search(stem)
    return "-".join(found.groups()) if found else otherwise


def put_delta(df: DataFrame, path: str, date: str) -> int:
    """Make ``df`` the rows of one day, whatever that day held before; returns their number.

    Dynamic overwrite leaves a partition alone that gets no rows, so a day that has become empty is removed.
    """
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("n"))
        .withColumn(DELTA, F.lit(date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DELTA)
        .parquet(path)
    )
    if not written.get["n"]:
        storage.remove_directory(df.sparkSession, f"{path}/{DELTA}={date}")
    return written.get["n"]


def delta_dates(spark: SparkSession, path: str) -> list[str]:
    """Days of a zone table, oldest first: one listing, no data or footer is opened."""
    prefix = f"{DELTA}="
    return sorted(n.removeprefix(prefix) for n, is_dir in storage.entries(spark, path) if is_dir and n.startswith(prefix))


def zone_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All days of a table with their ``delta_date``; narrower stored numbers widen to the declared types."""
    declared = T.StructType([*schema, T.StructField(DELTA, T.DateType())])
    if not delta_dates(spark, path):
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).parquet(path)


def latest_of_zone(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, str]:
    """The newest day alone: its date is a partition filter, so one partition is listed and opened."""
    dates = delta_dates(spark, path)
    if not dates:
        raise FileNotFoundError(f"no delta in {path}")
    return zone_scan(spark, path, schema).where(F.col(DELTA) == F.lit(dates[-1]).cast("date")).drop(DELTA), dates[-1]
