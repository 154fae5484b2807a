"""Which files a reader has taken already, kept as a table.

A file counts as taken if its path, length and modification time are on record, so a delta that was delivered again is
read again. Files are listed by Spark's file source without their content; what is on record is left out by an anti
join, and only the names of new files come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflume.sources import storage

FIELDS = "path string, length long, modified timestamp"


class FileLedger:
    """The record of one reader under ``root``; every ``record`` adds files and replaces none."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def taken(self) -> DataFrame:
        if not storage.entries(self.spark, self.root):
            return self.spark.createDataFrame([], FIELDS)
        return self.spark.read.schema(FIELDS).parquet(self.root)

    def listed(self, paths: list[str]) -> DataFrame:
        """Files of these files and folders."""
        if not paths:
            return self.spark.createDataFrame([], FIELDS)
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
        return found.select("path", "length", F.col("modificationTime").alias("modified"))

    def unread(self, paths: list[str]) -> DataFrame:
        return self.listed(paths).join(self.taken(), ["path", "length", "modified"], "left_anti")

    def record(self, files: DataFrame) -> None:
        """Call it when what was read is safe; a reader that dies before reads the same files again."""
        files.coalesce(1).write.mode("append").parquet(self.root)
