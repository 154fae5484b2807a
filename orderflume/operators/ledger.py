"""What the run knows per order id, gathered in one shuffle.

Key conflicts, orphans, cascade membership, the set of order ids and the counts of the
contract all ask questions per order id of the same three tables. The ledger answers them
from one narrow aggregate: the id and a few counters per task and order travel, never rows,
so an order with a third of all items is one ledger line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.operators.contract import CASCADE, COPIES, NULLS, ORPHAN, REASON, REASONS

SHORT_NAMES = {"df_orders": "orders", "df_order_items": "items", "df_payments": "payments"}
CHILDREN = ("df_order_items", "df_payments")
# distinct rows, raw rows, distinct rows a row rule rejected
COUNTERS = ("versions", "rows", "rejected")


def order_ledger(flagged: dict[str, DataFrame]) -> DataFrame:
    """One line per order id (null is an id of its own) with the counters of each table."""
    values = {"versions": "1L", "rows": COPIES, "rejected": f"if({REASON} is null, 0L, 1L)"}
    frames = [
        flagged[table].selectExpr(
            "order_id",
            *[
                f"{values[c] if short == own else '0L'} as {short}_{c}"
                for short in SHORT_NAMES.values()
                for c in COUNTERS
            ],
        )
        for table, own in SHORT_NAMES.items()
    ]
    return (
        reduce(DataFrame.unionByName, frames)
        .groupBy("order_id")
        .agg(
            *[
                F.expr(f"sum({s}_{c}) as {s}_{c}") for s in SHORT_NAMES.values() for c in COUNTERS
            ]
        )
    )


def _invalid(table: str) -> str:
    """An order row was rejected or, as payments see it, one of its items was."""
    items = " or items_rejected > 0" if table == "df_payments" else ""
    return f"(orders_rejected > 0{items})"


_VALID = "(orders_versions > orders_rejected)"


def ledger_membership(ledger: DataFrame, table: str) -> DataFrame:
    """Membership of order ids for pruning a child table; other columns come along."""
    extra = [c for c in ledger.columns if c.endswith("_int")]
    return ledger.where("order_id is not null and orders_versions + items_versions > 0").selectExpr(
        "order_id", f"{_VALID} as _valid", f"{_invalid(table)} as _invalid", *extra
    )


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """One row with every total the gate and the contract report, in one pass."""
    known = "order_id is not null"
    columns = [f"coalesce(sum(if({known} and {_VALID}, 1, 0)), 0L) as valid_orders"]
    for table, s in SHORT_NAMES.items():
        columns += [
            f"coalesce(sum({s}_rows), 0L) as {s}_rows",
            f"coalesce(sum({s}_versions), 0L) as {s}_versions",
            f"coalesce(sum({s}_rejected), 0L) as {s}_rejected",
            f"count_if({s}_versions > 1) as {s}_conflicting_keys",
            f"coalesce(sum(if({s}_versions > 0, {s}_rows - 1, 0L)), 0L) as {s}_repeated_rows",
        ]
        if table in CHILDREN:
            left = f"{s}_versions - {s}_rejected"
            bad = f"{known} and {_invalid(table)}"
            columns += [
                f"coalesce(sum(if({known} and orders_versions = 0, {s}_rows, 0L)), 0L) as {s}_orphans",
                f"coalesce(sum(if({bad}, {left}, 0L)), 0L) as {s}_cascade",
                f"coalesce(sum(if(not ({bad}) and not {_VALID}, {left}, 0L)), 0L) as {s}_ghosts",
            ]
    return ledger.selectExpr(*columns)


def key_numbers(summary: dict[str, int], table: str) -> tuple[int, int]:
    """Conflicting keys and repeated rows of one table."""
    s = SHORT_NAMES[table]
    return summary[f"{s}_conflicting_keys"], summary[f"{s}_repeated_rows"]


def child_metrics(summary: dict[str, int], table: str, removed_column: int) -> dict[str, object]:
    """Contract counts of a child table, as ``contract_metrics`` reports them."""
    s = SHORT_NAMES[table]
    removed = dict.fromkeys(REASONS, 0)
    removed[NULLS] = summary[f"{s}_rejected"]
    removed[CASCADE] = summary[f"{s}_cascade"]
    removed[ORPHAN] = summary[f"{s}_ghosts"] if summary["valid_orders"] else 0
    return {
        "table_name": table,
        "initial_rows": summary[f"{s}_rows"],
        "deduplicated_rows": summary[f"{s}_rows"] - summary[f"{s}_versions"],
        **removed,
        "final_rows": summary[f"{s}_versions"] - sum(removed.values()),
        "removed_column": removed_column,
    }
