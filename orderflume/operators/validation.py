"""Read-only checks. Every finding is a row (table_name, rule, column_name, severity, n)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.functions.rows import any_null, numeric_columns
from orderflume.functions.temporal import parsed
from orderflume.model import EVENT_FACT, REQUIRED_TIMESTAMPS, TABLES, TRANSACTION_DETAIL, TableSpec
from orderflume.operators.contract import COPIES, collapse, data_columns

CHECKS = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("rule", T.StringType(), False),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("severity", T.StringType(), False),
        T.StructField("n", T.LongType(), False),
    ]
)
ERROR, WARNING, INFO = "error", "warning", "info"

# All text that a cast to double can read, and some that it cannot. A cast that fails costs an exception, some
# microseconds for every id that is no number; text outside the pattern need not be tried.
NUMBER_LIKE = (
    "(?i)^[\\x00-\\x20]*[-+]?(nan|inf(inity)?|0x[0-9a-f]*[.]?[0-9a-f]*p[-+]?[0-9]+[df]?"
    "|[0-9]*[.]?[0-9]*(e[-+]?[0-9]+)?[df]?)[\\x00-\\x20]*$"
)


# --- building blocks: counts as SQL text ------------------------------------------------


def rows_where(condition: str) -> str:
    """Raw rows (copies included) that meet a condition."""
    return f"coalesce(sum(case when {condition} then {COPIES} end), 0L)"


def key_profile(collapsed: DataFrame, key: list[str]) -> DataFrame:
    """One row: keys with more than one distinct row, and repeats of keys.

    Works on a collapsed frame; a null key is a key like any other. Both shuffles that lead
    here combine before they ship, so neither copies nor a dominant key gather anywhere.
    """
    per_key = collapsed.groupBy(*key).agg(
        F.expr("count(1) as _versions"), F.expr(f"sum({COPIES}) as _rows")
    )
    return per_key.selectExpr(
        "count_if(_versions > 1) as conflicting_keys",
        "coalesce(sum(_rows - 1), 0L) as repeated_rows",
    )


def null_counts(columns: list[str]) -> dict[str, str]:
    return {c: rows_where(f"{c} is null") for c in columns}


def unparsable_counts(df: DataFrame) -> dict[str, str]:
    return {c: rows_where(f"{parsed(df, c)} is null") for c in REQUIRED_TIMESTAMPS}


def chronology_counts(df: DataFrame) -> dict[str, str]:
    purchase = parsed(df, "order_purchase_timestamp")
    return {
        "approval_precedes_purchase": rows_where(f"{parsed(df, 'order_approved_at')} < {purchase}"),
        "delivery_precedes_purchase": rows_where(
            f"{parsed(df, 'order_delivered_timestamp')} < {purchase}"
        ),
    }


def negative_counts(df: DataFrame, text_numbers: bool = False) -> dict[str, str]:
    """Negative values per numeric column.

    With ``text_numbers`` text columns are looked at too: those declared numeric count their
    negatives whatever else they hold, others if each of their values reads as a number.
    """
    declared = {f.name for spec in TABLES.values() for f in spec.schema if isinstance(f.dataType, T.NumericType)}
    counts = {c: rows_where(f"`{c}` < 0") for c in numeric_columns(df) if c != COPIES}
    if text_numbers:
        for f in df.schema:
            if isinstance(f.dataType, T.StringType) and f.name in data_columns(df):
                number = f"case when `{f.name}` rlike r'{NUMBER_LIKE}' then try_cast(`{f.name}` as double) end"
                words = f"count_if(`{f.name}` is not null and ({number}) is null)"
                below = rows_where(f"({number}) < 0")
                counts[f.name] = below if f.name in declared else f"case when {words} = 0 then {below} else 0L end"
    return counts


# --- one table --------------------------------------------------------------------------


def is_collapsed(df: DataFrame) -> bool:
    return COPIES in df.columns


Finding = tuple[str, str | None, str, str]  # rule, column, severity, count as SQL text


def _findings(one_row: DataFrame, name: str, findings: list[Finding]) -> DataFrame:
    """Turn counts over a one-row frame into rows, leaving zeros out."""

    def text(value: str | None) -> str:
        return "cast(null as string)" if value is None else f"'{value}'"

    structs = [
        f"named_struct('table_name', '{name}', 'rule', '{rule}', 'column_name', {text(column)},"
        f" 'severity', '{severity}', 'n', cast(coalesce({n}, 0) as bigint))"
        for rule, column, severity, n in findings
    ]
    return one_row.selectExpr(f"inline(array({', '.join(structs)}))").where("n > 0")


def row_checks(df: DataFrame, spec: TableSpec, text_numbers: bool = False) -> list[Finding]:
    """The checks of a table that look at one row at a time, as counts over ``_copies``."""
    checks: list[Finding] = [("null_primary_key", None, WARNING, rows_where(any_null(spec.primary_key)))]
    checks += [("null_values", c, WARNING, n) for c, n in null_counts(spec.non_nullable).items()]
    if spec.role == EVENT_FACT:
        checks += [("unparsable_timestamp", c, WARNING, n) for c, n in unparsable_counts(df).items()]
        checks += [(rule, None, WARNING, n) for rule, n in chronology_counts(df).items()]
    if spec.role == TRANSACTION_DETAIL:
        checks += [("negative_values", c, ERROR, n) for c, n in negative_counts(df, text_numbers).items()]
    return checks


class WatchedTable:
    """A table whose row checks are counted while it is written, so that nobody reads it again for them.

    Write ``frame``, then ask for ``findings``. The counts come before any later shuffle, in the tasks that write, and
    Spark counts each of them once however often a task is repeated.
    """

    def __init__(self, df: DataFrame, spec: TableSpec, text_numbers: bool = False):
        self.spec, self.seen = spec, Observation()
        counted = df if is_collapsed(df) else df.selectExpr("*", f"1L as {COPIES}")
        self.checks = row_checks(counted, spec, text_numbers)
        counts = [F.expr(n).alias(f"n{i}") for i, (_, _, _, n) in enumerate(self.checks)]
        self.frame = counted.observe(self.seen, F.expr(rows_where("true")).alias("n_rows"), *counts).select(df.columns)

    def findings(self) -> list[dict]:
        """The same rows as ``validate_table`` gives for a table without repeated keys."""
        counted = self.seen.get
        empty = [("empty_dataset", None, ERROR, 1)] if not counted["n_rows"] else []
        found = [(rule, column, severity, counted[f"n{i}"] or 0) for i, (rule, column, severity, _) in enumerate(self.checks)]
        return [dict(zip(CHECKS.names, (self.spec.name, *f))) for f in empty + found if f[3]]


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that more than one row has; only the key is read."""
    return df.groupBy(*key).count().where("count > 1")


def validate_table(
    df: DataFrame,
    spec: TableSpec,
    text_numbers: bool = False,
    known_keys: tuple[int, int] | None = None,
) -> DataFrame:
    """All checks of one table as one plan.

    ``df`` may be a collapsed frame (then no copy is shipped again) or any other frame. An
    empty table, a missing column and a key conflict each stop the checks behind them.
    ``known_keys`` are its conflicting keys and repeated rows, if they have been counted.
    """
    repeated_names = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if repeated_names:
        df = df.toDF(*[c if df.columns.index(c) == i else f"{c}_{i}" for i, c in enumerate(df.columns)])
    missing = sorted(set(spec.required) - set(df.columns))
    if missing:
        return _findings(
            df.selectExpr("count(1) as n_rows"),
            spec.name,
            [("empty_dataset", None, ERROR, "if(n_rows = 0, 1, 0)")]
            + [("missing_required_column", c, ERROR, "if(n_rows > 0, 1, 0)") for c in missing],
        )

    if not is_collapsed(df):
        df = collapse(df)
    key = list(spec.primary_key)
    counts = row_checks(df, spec, text_numbers)
    aliases = [f"n{i}" for i in range(len(counts))]
    profile = df.selectExpr(
        f"coalesce(sum({COPIES}), 0L) as n_rows",
        *[f"{n} as {alias}" for alias, (_, _, _, n) in zip(aliases, counts)],
    )
    # Both aggregates are one row; stacking them avoids a join.
    if known_keys is None:
        keys = key_profile(df, key)
    else:
        conflicting, repeated = known_keys
        keys = df.sparkSession.range(1).selectExpr(
            f"{conflicting}L as conflicting_keys", f"{repeated}L as repeated_rows"
        )
    merged = profile.unionByName(keys, allowMissingColumns=True).selectExpr(
        *[f"max({c}) as {c}" for c in ("n_rows", *aliases, "conflicting_keys", "repeated_rows")]
    )
    sound = "conflicting_keys = 0"
    return _findings(
        merged,
        spec.name,
        [
            ("empty_dataset", None, ERROR, "if(n_rows = 0, 1, 0)"),
            ("conflicting_primary_key", None, ERROR, "conflicting_keys"),
            ("repairable_duplicates", None, WARNING, f"if({sound}, repeated_rows, 0)"),
        ]
        + [("duplicate_column_name", c, WARNING, f"if({sound}, 1, 0)") for c in repeated_names]
        + [
            (rule, column, severity, f"if({sound}, {alias}, 0)")
            for alias, (rule, column, severity, _) in zip(aliases, counts)
        ],
    )


# --- across tables ----------------------------------------------------------------------


def orphan_count(child: DataFrame, orders: DataFrame) -> DataFrame:
    """One row ``n``: child rows whose order id no order has; null ids are not counted.

    The child is summed per id first, so a dominant id is one row by the time it joins.
    """
    weight = f"sum({COPIES})" if is_collapsed(child) else "count(1)"
    per_order = child.where("order_id is not null").groupBy("order_id").agg(F.expr(f"{weight} as _n"))
    parents = orders.where("order_id is not null").select("order_id").distinct()
    return per_order.join(parents, "order_id", "left_anti").selectExpr("coalesce(sum(_n), 0L) as n")


def validate_references(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Orphan findings for items and payments; nothing if one of the tables is absent."""
    needed = ("df_orders", "df_order_items", "df_payments")
    if any("order_id" not in getattr(tables.get(t), "columns", ()) for t in needed):
        return []
    return [
        _findings(
            orphan_count(tables[child], tables["df_orders"]),
            child,
            [("orphan_rows", "order_id", WARNING, "n")],
        )
        for child in needed[1:]
    ]


def validate_tables(
    tables: dict[str, DataFrame], text_numbers: frozenset[str] = frozenset()
) -> DataFrame:
    """The whole report as one frame: each table on its own, then references between them."""
    frames = [
        validate_table(df, TABLES[name], name in text_numbers) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, frames + validate_references(tables))
