"""Independent Spark jobs of one driver."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run jobs side by side, so that small ones do not queue for the stragglers of large
    ones; results in order, first failure raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]
