"""Reading logical tables that arrive as dated deltas.

A delta is a file, or a directory of part files, named ``<table>_<YYYY_MM_DD>.<csv|parquet>``
under the folder of its zone. Picking the latest is pruning by name: no data is listed or
opened for the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.functions.rows import naive_timestamps
from orderflume.sources import storage
from orderflume.sources.file_ledger import FileLedger

FORMATS = ("csv", "parquet")


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header, every column as text: types are the contract's business, and text
    that fits no type must survive until a rule has counted it."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema]))
    return reader.csv(path)


def read_delta(spark: SparkSession, path: str) -> DataFrame:
    if path.lower().endswith(".csv"):
        return read_csv(spark, path)
    return naive_timestamps(spark.read.parquet(path))


def delta_names(spark: SparkSession, base: str, table: str, formats: tuple[str, ...] = FORMATS) -> list[str]:
    """Names of the deltas of a table, oldest first (a day's parquet after its csv)."""
    found = []
    for name, _ in storage.entries(spark, base):
        stem, _, suffix = name.rpartition(".")
        if suffix.lower() in formats and (stem == table or name.startswith(f"{table}_")):
            found.append(name)
    return sorted(found)


def latest_name(spark: SparkSession, base: str, table: str) -> str:
    names = delta_names(spark, base, table)
    if not names:
        raise FileNotFoundError(f"no delta of {table} in {base}")
    return names[-1]


def latest_delta(spark: SparkSession, base: str, table: str) -> tuple[DataFrame, str]:
    """The newest delta of a table and its name without suffix."""
    newest = latest_name(spark, base, table)
    return read_delta(spark, f"{base}/{newest}"), newest.rpartition(".")[0]


def historical_scan(
    spark: SparkSession, base: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """All parquet deltas of a table as one frame; rows repeated across deltas stay.

    With a declared schema this is a single scan, in which narrower stored numbers widen.
    Without one, deltas whose layouts fit together are scanned together and the groups united
    by name, in which the widest type of a column wins.
    """
    paths = [f"{base}/{n}" for n in delta_names(spark, base, table, ("parquet",))]
    if not paths:
        raise FileNotFoundError(f"no parquet delta of {table} in {base}")
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    return reduce(DataFrame.unionByName, [naive_timestamps(g) for g in layout_groups(spark, paths)])


def layout_groups(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Frames that together hold all deltas, each over deltas of one layout.

    One Spark job reads the footers of all files side by side and merges their schemas. Only if
    two contradict each other (a key as int and as bigint) are the deltas halved and each half
    asked again, so that the number of jobs grows with the changes of layout, not with the deltas.
    """
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*paths)]
    except Exception as failure:
        if len(paths) == 1 or "MERGE" not in str(failure).upper():
            raise
    half = len(paths) // 2
    groups = layout_groups(spark, paths[:half]) + layout_groups(spark, paths[half:])
    layouts: dict[str, list[DataFrame]] = {}
    for group in groups:  # halves that agree after all
        layouts.setdefault(group.schema.simpleString(), []).append(group)
    return [same[0] if len(same) == 1 else spark.read.schema(same[0].schema).parquet(*[p for g in same for p in g.inputFiles()]) for same in layouts.values()]


def dated_scan(
    spark: SparkSession, base: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """All parquet output of a table written by one run; a known schema saves reading footers."""
    if not delta_names(spark, base, table, ("parquet",)):
        raise FileNotFoundError(f"no parquet output of {table} in {base}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return naive_timestamps(reader.parquet(f"{base}/{table}_*.parquet"))


def key_scan(
    spark: SparkSession, base: str, table: str, key: str, names: list[str] | None = None
) -> list[DataFrame]:
    """One id column of the deltas of a table (of the named ones), CSV and parquet alike, as text."""
    chosen = delta_names(spark, base, table) if names is None else names
    frames = [read_delta(spark, f"{base}/{n}") for n in chosen]
    return [f.select(F.col(key).cast("string").alias(key)) for f in frames if key in f.columns]


def unread_deltas(
    spark: SparkSession, base: str, table: str, ledger: FileLedger
) -> tuple[list[str], DataFrame]:
    """Names of the deltas that hold a file the ledger lacks, and those files.

    Only the names come to the driver. A delta whose files are all on record gave its ids to the registry before, so no
    id is lost by not opening it.
    """
    names = delta_names(spark, base, table)
    files = ledger.unread([f"{base}/{n}" for n in names])
    of_delta = F.element_at(F.split(F.split_part("path", F.lit(base.rstrip("/").rpartition("/")[2] + "/"), F.lit(-1)), "/"), 1)
    held = {r[0] for r in files.select(of_delta.alias("delta")).distinct().collect()}
    return [n for n in names if n in held], files


def catalog_scan(spark: SparkSession, name: str) -> DataFrame:
    """An external table of the catalog; an empty one is an error."""
    df = spark.table(name)
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return naive_timestamps(df)


def catalog_increment(spark: SparkSession, name: str, ledger: FileLedger) -> tuple[DataFrame, DataFrame]:
    """Rows of a catalog table in files that the ledger lacks, and those files; nothing else is opened."""
    spark.catalog.refreshTable(name)
    table = spark.table(name)
    files = ledger.unread(table.inputFiles())
    paths = [r["path"] for r in files.select("path").collect()]  # names of new files
    if not paths:
        return naive_timestamps(table.limit(0)), files
    location = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    rows = spark.read.schema(table.schema).option("basePath", location).format(_format(spark, name)).load(paths)
    return naive_timestamps(rows), files


def _format(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Provider'").first()["data_type"].lower()
