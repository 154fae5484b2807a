"""Contract rules: collapse copies, reject rows with a reason, cascade to child tables.

Rules look at one row (plus membership of its order id), so running them in sequence equals
naming the first rule a row breaks. Every row of a collapsed table therefore carries
``_copies`` (how many identical raw rows it stands for) and ``_reason`` (null = kept), and
kept rows, rejected ids and all counts come from that one frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.functions.rows import any_null, any_of
from orderflume.functions.temporal import PARSED, Inferred, parsed, with_parsed
from orderflume.model import (
    ENTITY_REFERENCE,
    EVENT_FACT,
    REQUIRED_TIMESTAMPS,
    TABLES,
    TRANSACTION_DETAIL,
    TableSpec,
)
from orderflume.operators.lookup import lookup_join

COPIES, REASON = "_copies", "_reason"
BOOKKEEPING = (COPIES, REASON)

# fixed values: report names of the rules
UNPARSABLE = "removed_unparsable_timestamps"
IMPOSSIBLE = "removed_impossible_timestamps"
NULLS = "removed_null_values"
CASCADE = "removed_cascade_rows"
ORPHAN = "removed_ghost_orphan_rows"
REASONS = (UNPARSABLE, IMPOSSIBLE, NULLS, CASCADE, ORPHAN)


# --- collapse ---------------------------------------------------------------------------


def data_columns(df: DataFrame) -> list[str]:
    """The table's own columns, without what the contract keeps beside them."""
    return [c for c in df.columns if c not in BOOKKEEPING and not c.startswith(PARSED)]


def collapse(df: DataFrame) -> DataFrame:
    """One row per distinct row, with its number of copies.

    Copies merge before the shuffle, so a row repeated a billion times ships once per task.
    """
    return df.groupBy(*data_columns(df)).agg(F.expr(f"count(1) as {COPIES}"))


def deduplicate(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


# --- row rules --------------------------------------------------------------------------


def unparsable_timestamp(df: DataFrame) -> str:
    """A required timestamp is null or not in its format."""
    return any_of(f"{parsed(df, c)} is null" for c in REQUIRED_TIMESTAMPS if c in df.columns)


def impossible_timestamp(df: DataFrame) -> str:
    """Approved or delivered before the purchase; unknown times do not count."""
    purchase = parsed(df, "order_purchase_timestamp")
    early = any_of(
        f"{parsed(df, c)} < {purchase}" for c in ("order_approved_at", "order_delivered_timestamp")
    )
    return f"coalesce({early}, false)"


def null_violation(columns: list[str]) -> str:
    return any_null(columns)


RULES_BY_ROLE = {
    EVENT_FACT: (UNPARSABLE, IMPOSSIBLE, NULLS),
    TRANSACTION_DETAIL: (NULLS, CASCADE, ORPHAN),
    ENTITY_REFERENCE: (NULLS,),
}


def row_reason(df: DataFrame, spec: TableSpec) -> str:
    """First row rule of the table's role that a row breaks, else null."""
    predicates = {
        UNPARSABLE: unparsable_timestamp,
        IMPOSSIBLE: impossible_timestamp,
        NULLS: lambda _: null_violation(spec.non_nullable),
    }
    cases = [
        f"when {predicates[rule](df)} then '{rule}'"
        for rule in RULES_BY_ROLE[spec.role]
        if rule in predicates
    ]
    return f"case {' '.join(cases)} end"


def flag_rows(
    raw: DataFrame, spec: TableSpec, formats: dict[str, Inferred] | None = None
) -> DataFrame:
    """Collapsed table with the outcome of its row rules: one shuffle, done once per run.

    Timestamp text is parsed here and carried along for everything that follows; ``formats``
    are those found for columns without a declared one.
    """
    stamps = [f.name for f in spec.schema if isinstance(f.dataType, T.TimestampNTZType)]
    collapsed = with_parsed(collapse(raw), stamps, formats)
    return collapsed.selectExpr("*", f"{row_reason(collapsed, spec)} as {REASON}")


def kept(flagged: DataFrame) -> DataFrame:
    return flagged.where(f"{REASON} is null")


def keep_rows(df: DataFrame, violation: str) -> DataFrame:
    """Rows that do not break a rule."""
    return df.where(f"not ({violation})")


def rejected_ids(df: DataFrame, violation: str) -> DataFrame:
    """Distinct order ids of the rows that do."""
    return df.where(violation).select("order_id").distinct()


# --- membership and cascade -------------------------------------------------------------


def order_membership(orders: DataFrame, *children: DataFrame) -> DataFrame:
    """Per order id: did a row survive (``_valid``), was a row rejected (``_invalid``).

    ``orders`` and ``children`` are flagged tables. Children only add rejected ids; cascade
    is forward only, so pass the ones that come before the table to be pruned.
    """
    frames = [
        orders.selectExpr(
            "order_id", f"{REASON} is null as _valid", f"{REASON} is not null as _invalid"
        )
    ] + [
        child.where(f"{REASON} is not null").selectExpr(
            "order_id", "false as _valid", "true as _invalid"
        )
        for child in children
    ]
    return (
        reduce(DataFrame.unionByName, frames)
        .where("order_id is not null")
        .groupBy("order_id")
        .agg(F.expr("bool_or(_valid) as _valid"), F.expr("bool_or(_invalid) as _invalid"))
    )


def invalid_orders(membership: DataFrame) -> DataFrame:
    return membership.where("_invalid").select("order_id")


def valid_orders(membership: DataFrame) -> DataFrame:
    return membership.where("_valid").select("order_id")


def has_parents(membership: DataFrame) -> bool:
    """The parent check is off when no order survived at all."""
    return not membership.where("_valid").isEmpty()


def _child_reason(check_parent: bool) -> str:
    orphan = f"when not coalesce(_valid, false) then '{ORPHAN}'" if check_parent else ""
    return f"case when coalesce(_invalid, false) then '{CASCADE}' {orphan} end"


def prune_children(
    flagged: DataFrame, membership: DataFrame, check_parent: bool, unique: bool = False
) -> DataFrame:
    """Rows of a flagged child table that pass both the cascade and the parent rule.

    Further columns of ``membership`` (the order's surrogate) come along, which saves a
    second trip of all child rows to the same key. ``unique``: each order has one row.
    """
    extra = [c for c in membership.columns if c not in ("order_id", "_valid", "_invalid")]
    joined = lookup_join(kept(flagged), membership, "order_id", scan=flagged, unique=unique)
    return joined.where(f"{_child_reason(check_parent)} is null").select(*flagged.columns, *extra)


def _flag(ids: DataFrame) -> DataFrame:
    return ids.where("order_id is not null").select("order_id").distinct().selectExpr(
        "order_id", "true as _listed"
    )


def cascade_drop(df: DataFrame, invalid: DataFrame) -> DataFrame:
    """Rows whose order id is known and not among the rejected ones."""
    joined = lookup_join(df.where("order_id is not null"), _flag(invalid), "order_id", repeats=True)
    return joined.where("_listed is null").select(df.columns)


def enforce_parent(df: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows whose order id is among the surviving ones; no-op when there are none."""
    if valid.isEmpty():
        return df
    joined = lookup_join(df, _flag(valid), "order_id", repeats=True)
    return joined.where("_listed is not null").select(df.columns)


# --- schema -----------------------------------------------------------------------------


def conform(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns with their declared types, and columns to ``keep`` as they are;
    anything else is cut off."""
    missing = [c for c in spec.required if c not in df.columns]
    if missing:
        raise RuntimeError(f"{spec.name}: missing required columns: {missing}")
    return df.selectExpr(
        *[
            f"{parsed(df, f.name)} as {f.name}"
            if isinstance(f.dataType, T.TimestampNTZType)
            else f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}"
            for f in spec.schema
        ],
        *keep,
    )


# --- counts -----------------------------------------------------------------------------


def contract_metrics(
    flagged: DataFrame,
    spec: TableSpec,
    membership: DataFrame | None = None,
    check_parent: bool = True,
) -> DataFrame:
    """One row: what went in, what each rule removed, what is left.

    A child table is summed per order id before it meets the membership, so both sides of
    that join hold each id once, however many rows an order has.
    """
    keys = [REASON] if membership is None else ["order_id", REASON]
    counts = flagged.groupBy(*keys).agg(
        F.expr("count(1) as _rows"), F.expr(f"sum({COPIES}) as {COPIES}")
    )
    if membership is not None:
        counts = counts.join(membership, "order_id", "left").selectExpr(
            "_rows", COPIES, f"coalesce({REASON}, {_child_reason(check_parent)}) as {REASON}"
        )
    cut = len(data_columns(flagged)) - len(spec.required)
    return counts.selectExpr(
        f"'{spec.name}' as table_name",
        f"coalesce(sum({COPIES}), 0L) as initial_rows",
        f"coalesce(sum({COPIES} - _rows), 0L) as deduplicated_rows",
        *[f"coalesce(sum(case when {REASON} = '{r}' then _rows end), 0L) as {r}" for r in REASONS],
        f"coalesce(sum(case when {REASON} is null then _rows end), 0L) as final_rows",
        f"{cut}L as removed_column",
    )


def contract_table(
    raw: DataFrame,
    table: str,
    membership: DataFrame | None = None,
    check_parent: bool = True,
) -> DataFrame:
    """A raw table through all rules of its role, typed; lazy."""
    spec = TABLES[table]
    flagged = flag_rows(raw, spec)
    if spec.role == TRANSACTION_DETAIL and membership is not None:
        return conform(prune_children(flagged, membership, check_parent), spec)
    return conform(kept(flagged), spec)
