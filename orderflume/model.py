"""What the tables look like: roles, keys, column types, output schemas.

A nullable=False field is one the contract refuses nulls in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
FLOAT, STAMP = T.FloatType(), T.TimestampNTZType()

EVENT_FACT = "event_fact"
TRANSACTION_DETAIL = "transaction_detail"
ENTITY_REFERENCE = "entity_reference"


def _columns(*fields: tuple[str, T.DataType], optional: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(n, t, n in optional) for n, t in fields])


@dataclass(frozen=True)
class TableSpec:
    """One logical input table."""

    name: str
    role: str
    primary_key: tuple[str, ...]
    schema: T.StructType

    @property
    def required(self) -> list[str]:
        return self.schema.names

    @property
    def non_nullable(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


# --- fixed values: table names, columns, types and formats of the data model ------------
# Parents come before their children: the contract walks this order.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "df_orders",
            EVENT_FACT,
            ("order_id",),
            _columns(
                ("order_id", STRING),
                ("customer_id", STRING),
                ("order_status", STRING),
                ("order_purchase_timestamp", STAMP),
                ("order_approved_at", STAMP),
                ("order_delivered_timestamp", STAMP),
                ("order_estimated_delivery_date", STAMP),
                optional=(
                    "order_approved_at",
                    "order_delivered_timestamp",
                    "order_estimated_delivery_date",
                ),
            ),
        ),
        TableSpec(
            "df_order_items",
            TRANSACTION_DETAIL,
            ("order_id",),
            _columns(
                ("order_id", STRING),
                ("product_id", STRING),
                ("seller_id", STRING),
                ("price", FLOAT),
            ),
        ),
        TableSpec(
            "df_customers",
            ENTITY_REFERENCE,
            ("customer_id",),
            _columns(
                ("customer_id", STRING),
                ("customer_state", STRING),
                ("customer_city", STRING),
                ("customer_segment", STRING),
                ("account_creation_date", STAMP),
            ),
        ),
        TableSpec(
            "df_payments",
            TRANSACTION_DETAIL,
            ("order_id",),
            _columns(("order_id", STRING), ("payment_value", FLOAT)),
        ),
        TableSpec(
            "df_products",
            ENTITY_REFERENCE,
            ("product_id",),
            _columns(
                ("product_id", STRING),
                ("product_category_name", STRING),
                ("product_length_cm", FLOAT),
                ("product_height_cm", FLOAT),
                ("product_width_cm", FLOAT),
                ("product_fragility_index", STRING),
                ("product_weight_g", FLOAT),
                ("supplier_tier", STRING),
            ),
        ),
    )
}

# Accepted text of a timestamp column; anything else is unparsable.
DATE_TIME = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
DATE_ONLY = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
DATE_OR_DATE_TIME = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?$"
TIMESTAMP_TEXT = {
    "order_purchase_timestamp": DATE_TIME,
    "order_approved_at": DATE_TIME,
    "order_delivered_timestamp": DATE_TIME,
    "order_estimated_delivery_date": DATE_ONLY,
}
REQUIRED_TIMESTAMPS = list(TIMESTAMP_TEXT)

# Ids that get an integer surrogate. A table holds the id if its schema names it.
SURROGATE_KEYS = ("order_id", "customer_id", "product_id", "seller_id")

ASSEMBLED = T.StructType(
    [
        T.StructField("order_id_int", LONG),
        T.StructField("order_revenue", FLOAT),
        T.StructField("seller_id_int", LONG),
        T.StructField("customer_id_int", LONG),
        T.StructField("product_id_int", LONG),
        T.StructField("order_status", STRING),
        T.StructField("order_purchase_timestamp", STAMP),
        T.StructField("order_approved_at", STAMP),
        T.StructField("order_delivered_timestamp", STAMP),
        T.StructField("lead_time_days", INT),
        T.StructField("approval_lag_days", INT),
        T.StructField("delivery_delay_days", INT),
        T.StructField("order_date", STAMP),
        T.StructField("order_year_week", STRING),
    ]
)

WEEKLY_MEASURES = [
    T.StructField("order_year_week", STRING),
    T.StructField("week_start_date", STAMP),
    T.StructField("weekly_order_count", INT),
    T.StructField("weekly_delivered_orders", INT),
    T.StructField("weekly_cancelled_orders", INT),
    T.StructField("weekly_revenue", FLOAT),
    T.StructField("weekly_avg_lead_time", FLOAT),
    T.StructField("weekly_total_lead_time", LONG),
    T.StructField("weekly_avg_delivery_delay", FLOAT),
    T.StructField("weekly_total_delivery_delay", LONG),
    T.StructField("weekly_avg_approval_lag", FLOAT),
]

SELLER_DIM = T.StructType(
    [
        T.StructField("seller_id_int", LONG),
        T.StructField("first_order_date", STAMP),
        T.StructField("first_order_year_week", STRING),
    ]
)
# --- end of fixed values -----------------------------------------------------------------


def int_name(key: str) -> str:
    """Name of the surrogate column that goes with a string key."""
    return f"{key}_int"


def tables_with(key: str) -> list[str]:
    """Tables an id occurs in."""
    return [name for name, spec in TABLES.items() if key in spec.required]


def silver_schema(table: str) -> T.StructType:
    """Contracted table: the declared columns, then one surrogate per id in it."""
    spec = TABLES[table]
    surrogates = [T.StructField(int_name(k), LONG) for k in SURROGATE_KEYS if k in spec.required]
    return T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema] + surrogates)


def weekly_fact_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(f"{entity}_id_int", LONG), *WEEKLY_MEASURES])


def dimension_schema(table: str) -> T.StructType:
    """Reference table with its string id replaced by the surrogate."""
    return T.StructType(
        [
            T.StructField(int_name(f.name), LONG)
            if f.name in SURROGATE_KEYS
            else T.StructField(f.name, f.dataType)
            for f in TABLES[table].schema
        ]
    )


@dataclass(frozen=True)
class SemanticTable:
    name: str
    kind: str
    grain: tuple[str, ...]
    schema: T.StructType


def _module(entity: str, dimension: T.StructType) -> list[SemanticTable]:
    key = f"{entity}_id_int"
    return [
        SemanticTable(
            f"{entity}_weekly_fact", "fact", (key, "order_year_week"), weekly_fact_schema(entity)
        ),
        SemanticTable(f"{entity}_dim", "dim", (key,), dimension),
    ]


SEMANTIC_MODULES: dict[str, list[SemanticTable]] = {
    "seller_semantic": _module("seller", SELLER_DIM),
    "customer_semantic": _module("customer", dimension_schema("df_customers")),
    "product_semantic": _module("product", dimension_schema("df_products")),
}
