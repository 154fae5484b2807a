"""Taking over a delivered folder exactly once."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from orderflume.sources import storage
from orderflume.sources.deltas import read_csv

# fixed values: the delivery protocol
HANDSHAKE_FILE = "instruction.txt"
HANDSHAKE_TEXT = "file-upload=safe"


def handshake(spark: SparkSession, folder: str) -> bool:
    """The sender declares a folder complete."""
    path = f"{folder}/{HANDSHAKE_FILE}"
    return storage.exists(spark, path) and HANDSHAKE_TEXT in storage.read_text(spark, path)


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """A delivered file, or directory of part files, by what its suffix says it is."""
    suffix = path.rpartition(".")[2].lower()
    if suffix in ("csv", "txt"):
        return read_csv(spark, path)
    if suffix in ("parquet", "orc", "json"):
        return spark.read.format(suffix).load(path)
    raise ValueError(f"no reader for files of type .{suffix}")


def delivered(spark: SparkSession, folder: str, members: list[str]) -> DataFrame:
    """All files of one stem as one delta; several, which may differ in types, come as text."""
    frames = [read_file(spark, f"{folder}/{m}") for m in members]
    if len(frames) == 1:
        return frames[0]
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [f.selectExpr(*[f"cast(`{c}` as string) as `{c}`" for c in f.columns]) for f in frames],
    )


def ingest_batch(spark: SparkSession, folder: str, base: str) -> dict:
    """Archive every file of a delivered folder and add it to the raw zone.

    Files of one stem are one delta, whatever their types.

    A folder with a success marker is skipped. The marker is written last, and every file
    lands by overwrite, so a run that died half way is simply repeated. The first file that
    fails stops the rest.
    """
    name = folder.rstrip("/").rpartition("/")[2]
    marker = f"{base}/status/{name}.success"
    if storage.exists(spark, marker):
        return {"folder": name, "status": "skipped", "files_processed": [], "errors": []}

    report: dict = {
        "execution_id": str(uuid.uuid4()),
        "folder": name,
        "status": "success",
        "files_processed": [],
        "errors": [],
    }
    files = [n for n, _ in storage.entries(spark, folder) if n != HANDSHAKE_FILE]
    stems: dict[str, list[str]] = {}
    for n in files:
        stems.setdefault(n.rpartition(".")[0] or n, []).append(n)
    if not handshake(spark, folder) or not files:
        return {**report, "status": "failed", "errors": ["handshake missing or folder empty"]}

    for stem, members in stems.items():
        try:
            archived = f"{base}/archive/{name}/{stem}.parquet"
            delivered(spark, folder, members).write.mode("overwrite").parquet(archived)
            spark.read.parquet(archived).write.mode("overwrite").parquet(f"{base}/raw/{stem}.parquet")
        except Exception as failure:
            report["errors"].append(
                {
                    "file_name": ", ".join(members),
                    "error_type": type(failure).__name__,
                    "error_message": str(failure),
                }
            )
            report["status"] = "failed"
            break
        report["files_processed"].extend(members)
    storage.write_json(spark, f"{base}/logs/{name}_metadata.json", report)
    if report["status"] == "success":
        storage.write_text(spark, marker, "")
    return report
