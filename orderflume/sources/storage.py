"""Driver-side file system calls (names and markers only) on whatever storage Spark uses."""

from __future__ import annotations

import json
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def _handle(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.exists(target)


def entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is_directory) of what lies directly under a directory; hidden names left out."""
    fs, target = _handle(spark, path)
    if not fs.exists(target):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(target)]
    return sorted(e for e in found if not e[0].startswith((".", "_")))


def read_text(spark: SparkSession, path: str) -> str:
    """A small control file (marker, handshake, pointer)."""
    fs, target = _handle(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _handle(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, payload: Any) -> None:
    write_text(spark, path, json.dumps(payload, indent=2))


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet; ``FileExistsError`` if another writer was first."""
    fs, target = _handle(spark, path)
    try:
        stream = fs.create(target, False)
    except Exception as failure:
        if "already exists" in str(failure).lower() or "AlreadyExists" in str(failure):
            raise FileExistsError(path) from failure
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if read_text(spark, path) != text:  # a file system that lets two writers through keeps one of them
        raise FileExistsError(path)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target, then swap in one rename: readers see the old or the new."""
    pending = f"{path}.tmp"
    write_text(spark, pending, text)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(pending), hadoop.Path(path)
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one finished file; the target must not exist."""
    fs, old = _handle(spark, source)
    _, new = _handle(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names for checkpoints.

    Only a local master, as in tests, may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = current.get() if current.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="orderflume-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def remove_directory(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.delete(target, True)


class Stage:
    """Intermediate tables of one run, written so that later steps restart from disk."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{scratch_root(spark)}/stage-{uuid.uuid4().hex}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        # read back within minutes: cheap compression; a name is used once per run
        df.write.option("compression", "snappy").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
