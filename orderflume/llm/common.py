"""What the operators of this subpackage share: key arithmetic, staging, text batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.sources.storage import Stage, scratch_root

#: Code points of text that one numpy step works on.
STEP_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns; whatever else the table has stays out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fold(key: str, folds: int) -> Column:
    """crc32 of the key's decimal text modulo ``folds``; null for a null key."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


def spread(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone, even over keys."""
    return F.pmod(F.xxhash64(key, F.lit("spread")), F.lit(1 << 40)) / F.lit(float(1 << 40))


def stage(df: DataFrame, name: str = "part") -> DataFrame:
    """Write to the cluster's shared folder and read back: later steps restart from there."""
    return Stage(df.sparkSession).put(name, df)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each action within go once it has ended."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        spark.conf.set(cleanup, before)


def settle(df: DataFrame, name: str = "part") -> DataFrame:
    """Like ``stage`` for wide rows: zstd, and the shuffle files that led to the table go once it is written."""
    spark, path = df.sparkSession, f"{scratch_root(df.sparkSession)}/stage-{uuid.uuid4().hex}/{name}"
    with cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores before it as it takes to be none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_map(df: DataFrame, step: Callable[[pa.RecordBatch], dict], schema: str | T.StructType) -> DataFrame:
    """``step`` makes the columns of ``schema`` from each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = step(batch)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in made.values()], list(made))

    return df.mapInArrow(run, schema)


def in_steps(strings: list[str], most: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``most`` code points together, one text at least."""
    start = size = 0
    for i, s in enumerate(strings):
        if size and size + len(s) > most:
            yield start, i
            start, size = i, 0
        size += len(s) + 1
    if start < len(strings):
        yield start, len(strings)


def code_points(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, a 0 after each text, and the text that each belongs to."""
    joined = "\0".join(strings) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(s) + 1 for s in strings), dtype=np.int64, count=len(strings))
    return points, np.repeat(np.arange(len(strings), dtype=np.int64), lengths)
