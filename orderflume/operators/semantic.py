"""Weekly facts and dimensions per seller, customer and product."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.functions.rows import frozen
from orderflume.functions.temporal import week_start
from orderflume.model import SELLER_DIM, dimension_schema, weekly_fact_schema


# Weekly measures by name. A sum of nothing known is 0, an average of nothing is null.
MEASURES = {
    "week_start_date": f"min({week_start('order_date')})",
    "weekly_order_count": "count(order_id_int)",
    "weekly_delivered_orders": "count_if(order_status = 'delivered')",
    "weekly_cancelled_orders": "count_if(order_status = 'cancelled')",
    "weekly_revenue": "coalesce(sum(cast(order_revenue as double)), 0D)",
    "weekly_avg_lead_time": "avg(lead_time_days)",
    "weekly_total_lead_time": "coalesce(sum(lead_time_days), 0L)",
    "weekly_avg_delivery_delay": "avg(delivery_delay_days)",
    "weekly_total_delivery_delay": "coalesce(sum(delivery_delay_days), 0L)",
    "weekly_avg_approval_lag": "avg(approval_lag_days)",
}


def weekly_fact(events: DataFrame, entity: str) -> DataFrame:
    """Measures per (entity, ISO week): one hash aggregate around one exchange.

    A dominant seller costs one partial row per task and week, not its events.
    """
    return events.groupBy(f"{entity}_id_int", "order_year_week").agg(
        *[F.expr(f"{measure} as {name}") for name, measure in MEASURES.items()]
    )


def seller_dim(events: DataFrame) -> DataFrame:
    """First order day and week of each seller.

    Week labels are compared as numbers (``2020-W53`` as 202053), which order the same and,
    unlike text, aggregate in a hash map.
    """
    firsts = events.groupBy("seller_id_int").agg(
        F.expr("min(order_date) as first_order_date"),
        F.expr("min(cast(replace(order_year_week, '-W', '') as int)) as _week"),
    )
    digits = "lpad(cast(_week as string), 6, '0')"
    return firsts.selectExpr(
        "seller_id_int",
        "first_order_date",
        f"concat(substring({digits}, 1, 4), '-W', substring({digits}, 5, 2))"
        " as first_order_year_week",
    )


def build_module(module: str, events: DataFrame, dimensions: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frozen tables of one semantic module; ``dimensions`` holds the reference tables."""
    entity = module.removesuffix("_semantic")
    fact = frozen(weekly_fact(events, entity), weekly_fact_schema(entity))
    if entity == "seller":
        dimension = frozen(seller_dim(events), SELLER_DIM)
    else:
        source = f"df_{entity}s"
        dimension = frozen(dimensions[source], dimension_schema(source))
    return {f"{entity}_weekly_fact": fact, f"{entity}_dim": dimension}


def grain_check(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table: rows, distinct grain keys and keys that occur more than once."""
    frames = [
        df.groupBy(*grain)
        .agg(F.expr("count(1) as _rows"))
        .selectExpr(
            f"'{name}' as table_name",
            "coalesce(sum(_rows), 0L) as n_rows",
            "count(1) as n_keys",
            "count_if(_rows > 1) as repeated_keys",
        )
        for name, (df, grain) in tables.items()
    ]
    return reduce(DataFrame.unionByName, frames)
