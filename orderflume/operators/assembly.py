"""One event row per order, and reference tables by surrogate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflume.functions.rows import frozen
from orderflume.functions.temporal import day_floor, iso_year_week, whole_days
from orderflume.model import ASSEMBLED

# A pair of bigints as one decimal: the first in units of 10^19, which no bigint reaches.
_UNIT = "cast('10000000000000000000' as decimal(20, 0))"
_MISSING = f"{2**63 - 1}L"
_NARROW = f"{2**31}L"


def payments_by_order(payments: DataFrame) -> DataFrame:
    """Paid total per order; an order with only unknown amounts has paid 0."""
    return payments.groupBy("order_id_int").agg(
        F.expr("coalesce(sum(cast(payment_value as double)), 0D) as order_revenue")
    )


def items_by_order(items: DataFrame) -> DataFrame:
    """The (product, seller) pair of one item of each order, always the lowest pair.

    A pair is compared as one number, which keeps the aggregate in a hash map where ``min(struct)`` would sort every
    partition: a bigint if both surrogates fit into 31 bits, as they do up to two billion ids, else a decimal. Each line
    pays for the one it needs; the two minima meet once per order. A missing surrogate takes the top value, so known
    pairs come first.
    """
    pair = (
        f"cast(coalesce(product_id_int, {_MISSING}) as decimal(19, 0)) * {_UNIT}"
        f" + cast(coalesce(seller_id_int, {_MISSING}) as decimal(19, 0))"
    )
    narrow = " and ".join(f"{c} >= 0 and {c} < {_NARROW}" for c in ("product_id_int", "seller_id_int"))
    lowest = items.groupBy("order_id_int").agg(
        F.expr(f"min(case when {narrow} then shiftleft(product_id_int, 31) | seller_id_int end) as _small"),
        F.expr(f"min(case when {narrow} then null else cast({pair} as decimal(38, 0)) end) as _wide"),
    )
    product, seller = "shiftright(_small, 31)", f"_small & {2**31 - 1}L"
    small = f"cast(cast({product} as decimal(19, 0)) * {_UNIT} + cast({seller} as decimal(19, 0)) as decimal(38, 0))"
    alone = "_wide is null or "
    return lowest.selectExpr("order_id_int", "_small", "_wide", f"{alone}coalesce({small} <= _wide, false) as _is_small").selectExpr(
        "order_id_int",
        f"if(_is_small, {product}, nullif(_wide div {_UNIT}, {_MISSING})) as product_id_int",
        f"if(_is_small, {seller}, nullif(cast(_wide % {_UNIT} as bigint), {_MISSING})) as seller_id_int",
    )


def merge_tables(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders that have items, with their pair and, if paid, their revenue.

    Children are summed per order before the join and keep that partitioning through it:
    three exchanges in all. Order rows are unique per delta (the gate sees to it), so the
    left side has no key heavier than the number of deltas.
    """
    columns = [
        "order_id_int",
        "customer_id_int",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_timestamp",
        "order_estimated_delivery_date",
    ]
    return (
        orders.select(columns)
        .join(items_by_order(items), "order_id_int")
        .join(payments_by_order(payments), "order_id_int", "left")
    )


def derive_fields(merged: DataFrame) -> DataFrame:
    """Day counts between the milestones, the order day and its ISO week."""
    days = {
        "lead_time_days": whole_days("order_delivered_timestamp", "order_approved_at"),
        "approval_lag_days": whole_days("order_approved_at", "order_purchase_timestamp"),
        "delivery_delay_days": whole_days(
            "order_delivered_timestamp", "order_estimated_delivery_date"
        ),
    }
    return merged.selectExpr(
        *[c for c in merged.columns if c != "order_estimated_delivery_date"],
        *[f"cast({days_between} as int) as {name}" for name, days_between in days.items()],
        f"{day_floor('order_purchase_timestamp')} as order_date",
        f"{iso_year_week('order_purchase_timestamp')} as order_year_week",
    )


def assemble_events(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    return frozen(derive_fields(merge_tables(orders, items, payments)), ASSEMBLED)


def dimension_reference(df: DataFrame, key: str, schema: T.StructType) -> DataFrame:
    """One row per key; of the rows a key has in several deltas the lowest one is kept."""
    rest = ", ".join(c for c in schema.names if c != key)
    chosen = df.groupBy(key).agg(F.expr(f"min(struct({rest})) as _row"))
    return frozen(chosen.select(key, "_row.*"), schema)
