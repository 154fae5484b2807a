"""The five raw tables, derived from the star-schema test tables.

Each text is valid Spark SQL and ANSI SQL alike (``{orders}`` and so on stand for the source
tables), so the same rows can be produced in either engine. Faults a contract must catch are
placed by the order or line key: repeated rows, nulls, broken text, deliveries before the
purchase, items of orders that do not exist, unpaid orders.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflume.model import SURROGATE_KEYS, TABLES, TRANSACTION_DETAIL, int_name
from orderflume.operators.assembly import assemble_events
from orderflume.operators.contract import (
    conform,
    flag_rows,
    has_parents,
    kept,
    order_membership,
    prune_children,
)
from orderflume.plans.jobs import together
from orderflume.sources.storage import Stage

_ORDERS = """
select concat('o', cast(o_orderkey as string)) as order_id,
       case when o_orderkey % 103 = 7 then null
            else concat('c', cast(o_custkey as string)) end as customer_id,
       case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
            else 'cancelled' end as order_status,
       case when o_orderkey % 97 = 5 then 'garbage'
            else cast(o_orderdate as string) end as order_purchase_timestamp,
       cast(o_orderdate + (o_orderkey % 72) * interval '1' hour as string) as order_approved_at,
       case when o_orderkey % 101 = 3 then cast(o_orderdate - interval '1' day as string)
            else cast(o_orderdate + (o_orderkey % 72 + o_orderkey % 400) * interval '1' hour
                      as string) end as order_delivered_timestamp,
       substring(cast(o_orderdate + interval '10' day as string), 1, 10)
            as order_estimated_delivery_date
from {orders}
"""

RAW_SQL = {
    "df_orders": f"""
select * from ({_ORDERS}) once
union all
select * from ({_ORDERS.strip()} where o_orderkey % 89 = 1) again
""",
    "df_order_items": """
select case when l_orderkey % 107 = 2 then concat('ghost', cast(l_orderkey as string))
            else concat('o', cast(l_orderkey as string)) end as order_id,
       concat('p', cast(min(l_partkey) as string)) as product_id,
       case when l_orderkey % 109 = 4 then null
            else concat('s', cast(min(l_suppkey) as string)) end as seller_id,
       round(min(l_extendedprice), 2) as price
from {lineitem}
group by l_orderkey
""",
    "df_payments": """
select concat('o', cast(o_orderkey as string)) as order_id, o_totalprice as payment_value
from {orders}
where o_orderkey % 13 <> 6
""",
    "df_customers": """
select concat('c', cast(c_custkey as string)) as customer_id,
       n_name as customer_state,
       concat('city', cast(c_nationkey as string)) as customer_city,
       c_mktsegment as customer_segment,
       cast(cast('1994-01-01 00:00:00' as {naive}) + (c_custkey % 300) * interval '1' day
            as string) as account_creation_date
from {customer} join {nation} on c_nationkey = n_nationkey
""",
    "df_products": """
select concat('p', cast(p_partkey as string)) as product_id,
       p_type as product_category_name,
       cast(p_size as double) as product_length_cm,
       cast(p_size % 7 + 1 as double) as product_height_cm,
       cast(p_size % 5 + 1 as double) as product_width_cm,
       case p_size % 3 when 0 then 'low' when 1 then 'medium' else 'high' end
            as product_fragility_index,
       p_retailprice as product_weight_g,
       p_brand as supplier_tier
from {part}
""",
    # Payments of which some are negative: fatal at the raw gate, for that check alone.
    "df_payments_refunds": """
select concat('o', cast(o_orderkey as string)) as order_id,
       case when o_orderkey % 997 = 11 then -o_totalprice else o_totalprice end as payment_value
from {orders}
where o_orderkey % 13 <> 6
""",
}
SOURCES = ("nation", "customer", "part", "orders", "lineitem", "documents", "events")


class Inputs:
    """Raw, contracted and integer-keyed forms of the test tables.

    Flagged tables and order membership are read by several steps, so they are staged the
    first time they are asked for; everything else is lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def stage(self) -> Stage:
        return Stage(self.spark)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, table: str) -> DataFrame:
        text = RAW_SQL[table].replace("{naive}", "timestamp_ntz")
        used = {s: self.source(s) for s in SOURCES if f"{{{s}}}" in text}
        return self.spark.sql(text, **used)

    @cache
    def flagged(self, table: str) -> DataFrame:
        return self.stage.put(f"flagged_{table}", flag_rows(self.raw(table), TABLES[table]))

    @cache
    def membership(self, table: str) -> DataFrame:
        """Order ids as ``table`` sees them: payments also see what the items rejected."""
        before = [] if table == "df_order_items" else [self.flagged("df_order_items")]
        ids = order_membership(self.flagged("df_orders"), *before)
        return self.stage.put(f"membership_{table}", ids)

    def prepare(self, *tables: str) -> None:
        """Stage what several tables need side by side."""
        children = [t for t in tables if TABLES[t].role == TRANSACTION_DETAIL]
        wanted = {*tables, *(("df_orders",) if children else ())}
        if "df_payments" in children:
            wanted.add("df_order_items")
        together(self.spark, *[lambda t=t: self.flagged(t) for t in wanted])
        if children:
            together(self.spark, *[lambda t=t: self.membership(t) for t in children])

    def contracted(self, table: str) -> DataFrame:
        self.prepare(table)
        spec = TABLES[table]
        if spec.role != TRANSACTION_DETAIL:
            return conform(kept(self.flagged(table)), spec)
        ids = self.membership(table)
        return conform(prune_children(self.flagged(table), ids, has_parents(ids)), spec)

    def keyed(self, table: str) -> DataFrame:
        """Contracted table with the source's own integer keys in the surrogate columns."""
        df = self.contracted(table)
        keys = [k for k in SURROGATE_KEYS if k in df.columns]
        return df.withColumns(
            {int_name(k): F.substring(F.col(k), 2, 20).try_cast("bigint") for k in keys}
        )

    def event_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        tables = ("df_orders", "df_order_items", "df_payments")
        self.prepare(*tables)
        return tuple(self.keyed(t) for t in tables)

    def assembled(self) -> DataFrame:
        return assemble_events(*self.event_tables())
