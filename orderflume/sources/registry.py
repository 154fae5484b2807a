"""The registry of surrogates as a bucketed table.

All ids of a key that ever got a number lie in one external parquet table, bucketed and sorted by the id. A batch is
shuffled into the same buckets and meets the history where it lies: no plan moves the history. Every run appends its new
ids, one file a bucket at most.

The number of buckets is fixed when a registry is created (the width of the cluster's shuffles then) and stored beside
its files, so that any later session declares the same table. ``widen`` rewrites a registry that has outgrown it.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflume.model import int_name
from orderflume.sources import storage


class Registry:
    """Numbers of one id, under ``<root>/<key>.registry``."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int | None = None):
        self.spark, self.key, self.number = spark, key, int_name(key)
        self.root = f"{root}/{key}.registry"
        self.older = f"{root}/{key}"  # deltas of runs before the registry was bucketed
        self.wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # The current layout is named by the newest of its immutable descriptions: folder and number of buckets.
    def _layouts(self) -> list[str]:
        return [n for n, _ in storage.entries(self.spark, self.root) if n.endswith(".json")]

    def _layout(self) -> dict:
        names = self._layouts()
        if not names:
            self._describe(0, {"folder": "ids-0", "buckets": self.wanted})
            names = self._layouts()
            self._take_older()
        return json.loads(storage.read_text(self.spark, f"{self.root}/{names[-1]}"))

    def _describe(self, number: int, layout: dict) -> None:
        storage.create_text(self.spark, f"{self.root}/layout-{number:06d}.json", json.dumps(layout))

    def _take_older(self) -> None:
        if storage.entries(self.spark, self.older):
            old = self.spark.read.schema(f"{self.key} string, {self.number} bigint").parquet(f"{self.older}/*.parquet")
            self.append(old.groupBy(self.key).agg(F.min(self.number).alias(self.number)))

    def _declare(self, layout: dict) -> str:
        """Name of the table in this session's catalog."""
        path = f"{self.root}/{layout['folder']}"
        name = f"registry_{self.key}_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({self.key} string, {self.number} bigint) USING parquet"
            f" CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
        )
        self.spark.catalog.refreshTable(name)
        return name

    @property
    def buckets(self) -> int:
        return self._layout()["buckets"]

    def table(self) -> DataFrame:
        """All ids with their numbers, in buckets."""
        return self.spark.table(self._declare(self._layout()))

    def append(self, fresh: DataFrame) -> None:
        """Add ids that the registry does not hold."""
        layout = self._layout()
        self._fill(fresh, layout)

    def _fill(self, ids: DataFrame, layout: dict) -> None:
        dealt = ids.select(self.key, F.col(self.number).cast("bigint").alias(self.number)).repartition(layout["buckets"], self.key)
        dealt.write.insertInto(self._declare(layout))

    def widen(self, buckets: int) -> None:
        """Rewrite into more buckets; readers see the old folder until the new one is complete."""
        ids = self.table()
        layout = {"folder": f"ids-{uuid.uuid4().hex[:8]}", "buckets": buckets}
        self._fill(ids, layout)
        self._describe(len(self._layouts()), layout)
