"""Run queries in Spark and DuckDB over the same files and compare whole results.

``python -m tests.compare [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import tempfile
import time

import duckdb
import pandas as pd

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple("null" if v is None or v is pd.NaT or v != v else str(v) for v in row)
        for row in frame.itertuples(index=False, name=None)
    ]
    return sorted(rows)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    for ours, theirs in zip(normal(spark_frame), normal(sql_frame)):
        if ours != theirs:
            return f"first difference {ours} / {theirs}"
    return None


def main() -> None:
    from orderflume.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.TemporaryDirectory(prefix="orderflume-")
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": scratch.name,
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    registered, oracle = entry_points.queries(), entry_points.oracle_sql()
    for name in sys.argv[2:] or registered:
        started = time.time()
        try:
            frame = registered[name](spark, sf_dir)
            ours = frame.toPandas()
            taken = time.time() - started
            if name not in oracle:
                print(f"{name:28} rows only {len(ours)} {taken:.2f}s", flush=True)
                continue
            problem = difference(ours, connection.execute(oracle[name]).df())
            print(f"{name:28} {problem or 'ok'} rows={len(ours)} {taken:.2f}s", flush=True)
        except Exception as failure:
            print(f"{name:28} FAILED {type(failure).__name__}: {str(failure)[:600]}", flush=True)
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
