"""Row-level expressions over a list of columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def any_of(conditions: Iterable[str]) -> str:
    return " or ".join(f"({c})" for c in conditions) or "false"


def any_null(columns: Iterable[str]) -> str:
    return any_of(f"{c} is null" for c in columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Every zoned timestamp column as microsecond ``timestamp_ntz``; no-op without one."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: df[c].cast("timestamp_ntz") for c in zoned}) if zoned else df


def frozen(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order, strictly cast (overflow raises)."""
    missing = sorted(set(schema.names) - set(df.columns))
    if missing:
        raise RuntimeError(f"missing required columns: {missing}")
    return df.selectExpr(
        *[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema]
    )
