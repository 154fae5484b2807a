"""Timestamp expressions, as SQL text. None depends on the session time zone.

Text keeps plan building cheap: a whole projection goes to the JVM in one call.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderflume.model import DATE_OR_DATE_TIME, TIMESTAMP_TEXT, TableSpec


PARSED = "_at_"  # prefix of the columns that hold timestamps parsed ahead of use


class Layout(NamedTuple):
    """One way to write a timestamp, and how to turn it into the ISO order Spark reads."""

    name: str
    pattern: str
    iso: str = "$0"


_CLOCK = "([ T][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,9})?)?"
# fixed values: layouts that are tried where no format is declared; of equal counts the first wins. Each may go without
# the time of day, and with a T before it or a fraction behind it.
LAYOUTS = (
    Layout("year-month-day", f"^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}{_CLOCK}$"),
    Layout("year/month/day", f"^([0-9]{{4}})/([0-9]{{1,2}})/([0-9]{{1,2}}){_CLOCK}$", "$1-$2-$3$4"),
    Layout("day-month-year", f"^([0-9]{{1,2}})-([0-9]{{1,2}})-([0-9]{{4}}){_CLOCK}$", "$3-$2-$1$4"),
    Layout("day/month/year", f"^([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}){_CLOCK}$", "$3-$2-$1$4"),
)
# --- end of fixed values


class Inferred(NamedTuple):
    """The layout most values of a column have, and how many known values do not fit it."""

    layout: str
    matched: int
    unmatched: int


def in_layout(name: str, layout: Layout) -> str:
    iso = name if layout.iso == "$0" else f"regexp_replace({name}, '{layout.pattern}', '{layout.iso}')"
    return f"case when {name} rlike '{layout.pattern}' then try_cast({iso} as timestamp_ntz) end"


def infer_layout(df: DataFrame, names: list[str]) -> dict[str, Inferred]:
    """One aggregate over all rows: how many values of each column every layout reads."""
    counts = [f"count({in_layout(c, x)}) as `{c} {i}`" for c in names for i, x in enumerate(LAYOUTS)]
    row = df.selectExpr(*[f"count({c}) as `{c}`" for c in names], *counts).first()
    found = {}
    for c in names:
        read = [row[f"{c} {i}"] for i in range(len(LAYOUTS))]
        best = read.index(max(read))
        found[c] = Inferred(LAYOUTS[best].name, read[best], row[c] - read[best])
    return found


def inferred_formats(df: DataFrame, spec: TableSpec) -> dict[str, Inferred]:
    """Layouts of the text columns that ought to be timestamps but have no declared format."""
    open_ = [f.name for f in spec.schema if isinstance(f.dataType, T.TimestampNTZType) and f.name not in TIMESTAMP_TEXT]
    names = [c for c in open_ if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    return infer_layout(df, names) if names else {}


def parsed(df: DataFrame, name: str, found: Inferred | None = None) -> str:
    """Column as ``timestamp_ntz``; text outside the column's format becomes null."""
    if PARSED + name in df.columns:
        return PARSED + name
    if isinstance(df.schema[name].dataType, T.StringType):
        if found is not None:
            return in_layout(name, next(x for x in LAYOUTS if x.name == found.layout))
        pattern = TIMESTAMP_TEXT.get(name, DATE_OR_DATE_TIME)
        return f"case when {name} rlike '{pattern}' then try_cast({name} as timestamp_ntz) end"
    return f"cast({name} as timestamp_ntz)"


def with_parsed(df: DataFrame, names: list[str], formats: dict[str, Inferred] | None = None) -> DataFrame:
    """Adds parsed timestamps as columns, so that later rules, checks and casts reuse them."""
    present = [c for c in names if c in df.columns]
    return df.selectExpr("*", *[f"{parsed(df, c, (formats or {}).get(c))} as {PARSED}{c}" for c in present])


def whole_days(later: str, earlier: str) -> str:
    """Full 24-hour days between two timestamps, cut toward zero (-36 h is -1)."""
    return f"extract(day from ({later} - {earlier}))"


def day_floor(name: str) -> str:
    return f"cast(cast({name} as date) as timestamp_ntz)"


def week_start(name: str) -> str:
    """Monday 00:00 of the ISO week."""
    return f"cast(trunc(cast({name} as date), 'week') as timestamp_ntz)"


def iso_year_week(name: str) -> str:
    """``2020-W53`` style week label; labels sort in time order."""
    day = f"cast({name} as date)"
    return (
        f"concat(lpad(cast(extract(yearofweek from {day}) as string), 4, '0'), '-W',"
        f" lpad(cast(weekofyear({day}) as string), 2, '0'))"
    )
