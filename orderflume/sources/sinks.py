"""Writing zone tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dated_name(table: str, run_id: str) -> str:
    """``<table>_YYYY_MM_DD`` from the run's date."""
    return f"{table}_{run_id[:4]}_{run_id[4:6]}_{run_id[6:8]}"


def export(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Parquet output; False if it could not be written. Rows are never sorted for it."""
    try:
        df.write.mode(mode).parquet(path)
        return True
    except Exception as failure:  # the caller decides how fatal this is
        print(f"[ERROR] export to {path} failed: {failure}")
        return False
