"""The same answers in plain SQL, for a second engine to check the Spark queries against."""

from __future__ import annotations

from orderflume.model import TABLES
from orderflume.plans.inputs import RAW_SQL, SOURCES


def _raw(table: str) -> str:
    text = RAW_SQL[table].replace("{naive}", "timestamp")
    for source in SOURCES:
        text = text.replace(f"{{{source}}}", source)
    return text


_TIME = "'%Y-%m-%d %H:%M:%S'"
_P = f"try_strptime(order_purchase_timestamp, {_TIME})"
_A = f"try_strptime(order_approved_at, {_TIME})"
_D = f"try_strptime(order_delivered_timestamp, {_TIME})"
_E = "try_strptime(order_estimated_delivery_date, '%Y-%m-%d')"
_UNPARSABLE = f"({_P} is null or {_A} is null or {_D} is null or {_E} is null)"
_IMPOSSIBLE = f"coalesce({_A} < {_P} or {_D} < {_P}, false)"
_ORDER_NULL = "(order_id is null or customer_id is null or order_status is null or order_purchase_timestamp is null)"
_ITEM_NULL = "(order_id is null or product_id is null or seller_id is null or price is null)"
_PAY_NULL = "(order_id is null or payment_value is null)"

# Surrogates: ids in the order of (hash bucket, id).
_ORDER = "order by substring(md5({k}), 1, 3), {k}"


def _numbered(keys: str, key: str) -> str:
    """Ids of a frame, numbered densely from 1."""
    place = f"row_number() over ({_ORDER.format(k=key)})"
    return f"select {key}, {place} as {key}_int from {keys}"


def _number(key: str) -> str:
    return f"try_cast(substring({key}, 2) as bigint)"


def _weekly(events: str, entity: str) -> str:
    return f"""
select {entity}_id_int, order_year_week,
       min(date_trunc('week', order_date))::timestamp as week_start_date,
       count(order_id_int)::int as weekly_order_count,
       count(*) filter (where order_status = 'delivered')::int as weekly_delivered_orders,
       count(*) filter (where order_status = 'cancelled')::int as weekly_cancelled_orders,
       round(coalesce(sum(order_revenue::double), 0)::float::double, 2) as weekly_revenue,
       round(avg(lead_time_days)::float::double, 6) as weekly_avg_lead_time,
       coalesce(sum(lead_time_days), 0)::bigint as weekly_total_lead_time,
       round(avg(delivery_delay_days)::float::double, 6) as weekly_avg_delivery_delay,
       coalesce(sum(delivery_delay_days), 0)::bigint as weekly_total_delivery_delay,
       round(avg(approval_lag_days)::float::double, 6) as weekly_avg_approval_lag
from {events}
group by {entity}_id_int, order_year_week
"""


def _events(orders: str, items: str, payments: str) -> str:
    return f"""
select o.order_id_int, p.order_revenue, i.seller_id_int, o.customer_id_int, i.product_id_int,
       o.order_status, o.order_purchase_timestamp, o.order_approved_at,
       o.order_delivered_timestamp,
       date_sub('day', o.order_approved_at, o.order_delivered_timestamp)::int as lead_time_days,
       date_sub('day', o.order_purchase_timestamp, o.order_approved_at)::int as approval_lag_days,
       date_sub('day', o.order_estimated_delivery_date, o.order_delivered_timestamp)::int
           as delivery_delay_days,
       date_trunc('day', o.order_purchase_timestamp)::timestamp as order_date,
       strftime(o.order_purchase_timestamp, '%G-W%V') as order_year_week
from {orders} o
join (select order_id_int, min(product_id_int) as product_id_int,
             arg_min(seller_id_int, (product_id_int, seller_id_int)) as seller_id_int
      from {items} group by order_id_int) i on o.order_id_int = i.order_id_int
left join (select order_id_int, coalesce(sum(payment_value::double), 0)::float as order_revenue
           from {payments} group by order_id_int) p on o.order_id_int = p.order_id_int
"""


_CTES = {
    **{f"raw_{t[3:]}": _raw(t) for t in RAW_SQL},
    # contract
    "orders_flagged": f"""
select *, case when {_UNPARSABLE} then 'removed_unparsable_timestamps'
               when {_IMPOSSIBLE} then 'removed_impossible_timestamps'
               when {_ORDER_NULL} then 'removed_null_values' end as reason
from (select *, count(*) as copies from raw_orders group by all)""",
    "bad_orders": "select distinct order_id from orders_flagged where reason is not null",
    "good_orders": "select distinct order_id from orders_flagged where reason is null",
    "items_flagged": f"""
select *, case when {_ITEM_NULL} then 'removed_null_values'
               when order_id in (select order_id from bad_orders) then 'removed_cascade_rows'
               when order_id not in (select order_id from good_orders)
               then 'removed_ghost_orphan_rows' end as reason
from (select *, count(*) as copies from raw_order_items group by all)""",
    "bad_ids": """
select order_id from bad_orders
union select order_id from items_flagged where reason = 'removed_null_values'""",
    "payments_flagged": f"""
select *, case when {_PAY_NULL} then 'removed_null_values'
               when order_id in (select order_id from bad_ids) then 'removed_cascade_rows'
               when order_id not in (select order_id from good_orders)
               then 'removed_ghost_orphan_rows' end as reason
from (select *, count(*) as copies from raw_payments group by all)""",
    "customers_flagged": "select *, count(*) as copies, null as reason from raw_customers group by all",
    "products_flagged": "select *, count(*) as copies, null as reason from raw_products group by all",
    "orders_ok": f"""
select order_id, customer_id, order_status, {_P} as order_purchase_timestamp,
       {_A} as order_approved_at, {_D} as order_delivered_timestamp,
       {_E} as order_estimated_delivery_date
from orders_flagged where reason is null""",
    "items_ok": """
select order_id, product_id, seller_id, price::float as price from items_flagged where reason is null""",
    "payments_ok": """
select order_id, payment_value::float as payment_value from payments_flagged where reason is null""",
    "customers_ok": f"""
select customer_id, customer_state, customer_city, customer_segment,
       try_strptime(account_creation_date, {_TIME}) as account_creation_date
from customers_flagged""",
    "products_ok": """
select product_id, product_category_name, product_length_cm::float as product_length_cm,
       product_height_cm::float as product_height_cm, product_width_cm::float as product_width_cm,
       product_fragility_index, product_weight_g::float as product_weight_g, supplier_tier
from products_flagged""",
    # the sources' own numbers as surrogates
    "orders_keyed": f"""
select *, {_number('order_id')} as order_id_int, {_number('customer_id')} as customer_id_int
from orders_ok""",
    "items_keyed": f"""
select *, {_number('order_id')} as order_id_int, {_number('product_id')} as product_id_int,
       {_number('seller_id')} as seller_id_int from items_ok""",
    "payments_keyed": f"select *, {_number('order_id')} as order_id_int from payments_ok",
    "events": _events("orders_keyed", "items_keyed", "payments_keyed"),
    # persistent surrogates
    "order_keys": """
select order_id from raw_orders where order_id is not null
union select order_id from raw_order_items where order_id is not null
union select order_id from raw_payments where order_id is not null""",
    "customer_keys": """
select customer_id from raw_orders where customer_id is not null
union select customer_id from raw_customers""",
    "product_keys": """
select product_id from raw_order_items where product_id is not null
union select product_id from raw_products""",
    "seller_keys": "select distinct seller_id from raw_order_items where seller_id is not null",
    "registry": _numbered(
        "(select distinct order_id from raw_orders where order_status = 'delivered'"
        " and order_id is not null)",
        "order_id",
    ),
    "fresh": "select order_id from order_keys where order_id not in (select order_id from registry)",
    "order_map": _numbered("order_keys", "order_id"),
    "customer_map": _numbered("customer_keys", "customer_id"),
    "product_map": _numbered("product_keys", "product_id"),
    "seller_map": _numbered("seller_keys", "seller_id"),
    "orders_silver": """
select * from orders_ok left join order_map using (order_id) left join customer_map using (customer_id)""",
    "items_silver": """
select * from items_ok left join order_map using (order_id) left join product_map using (product_id)
left join seller_map using (seller_id)""",
    "payments_silver": "select * from payments_ok left join order_map using (order_id)",
    "events_silver": _events("orders_silver", "items_silver", "payments_silver"),
}


def _with(body: str) -> str:
    return "with " + ",\n".join(f"{n} as ({t})" for n, t in _CTES.items()) + "\n" + body


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
_HISTORY = """
select l_orderkey, l_linenumber, l_quantity from lineitem
union all
select l_orderkey, l_linenumber, l_quantity from lineitem where l_returnflag = 'R'
"""


def _metrics(table: str) -> str:
    name, spec = table[3:], TABLES[table]
    flagged = {"order_items": "items_flagged"}.get(name, f"{name}_flagged")
    raw = f"raw_{name}"
    reasons = (
        "removed_unparsable_timestamps",
        "removed_impossible_timestamps",
        "removed_null_values",
        "removed_cascade_rows",
        "removed_ghost_orphan_rows",
    )
    removed = ", ".join(f"count(*) filter (where reason = '{r}') as {r}" for r in reasons)
    return f"""
select '{spec.name}' as table_name, (select count(*) from {raw}) as initial_rows,
       (select count(*) from {raw}) - count(*) as deduplicated_rows, {removed},
       count(*) filter (where reason is null) as final_rows, 0::bigint as removed_column
from {flagged}
"""


def _check(table: str, rule: str, column: str | None, severity: str, count: str, source: str) -> str:
    column_sql = f"'{column}'" if column else "null::varchar"
    return (
        f"select '{table}' as table_name, '{rule}' as rule, {column_sql} as column_name,"
        f" '{severity}' as severity, ({count})::bigint as n from {source}"
    )


def _checks(*checks: str) -> str:
    return "select * from (" + " union all ".join(checks) + ") c where n > 0"


def _where(condition: str) -> str:
    return f"count(*) filter (where {condition})"


_RULE_ORDERS = [
    _check("df_orders", "repairable_duplicates", None, "warning", "count(*) - count(distinct order_id)", "raw_orders"),
    _check("df_orders", "null_primary_key", None, "warning", _where("order_id is null"), "raw_orders"),
    *[
        _check("df_orders", "null_values", c, "warning", _where(f"{c} is null"), "raw_orders")
        for c in TABLES["df_orders"].non_nullable
    ],
    *[
        _check("df_orders", "unparsable_timestamp", c, "warning", _where(f"{parsed} is null"), "raw_orders")
        for c, parsed in {
            "order_purchase_timestamp": _P,
            "order_approved_at": _A,
            "order_delivered_timestamp": _D,
            "order_estimated_delivery_date": _E,
        }.items()
    ],
    _check("df_orders", "approval_precedes_purchase", None, "warning", _where(f"{_A} < {_P}"), "raw_orders"),
    _check("df_orders", "delivery_precedes_purchase", None, "warning", _where(f"{_D} < {_P}"), "raw_orders"),
]


def _simple_rules(table: str, source: str) -> list[str]:
    spec = TABLES[table]
    key = spec.primary_key[0]
    return [
        _check(table, "repairable_duplicates", None, "warning", f"count(*) - count(distinct {key})", source),
        _check(table, "null_primary_key", None, "warning", _where(f"{key} is null"), source),
        *[_check(table, "null_values", c, "warning", _where(f"{c} is null"), source) for c in spec.non_nullable],
    ]


def _negatives(table: str, column: str, source: str) -> list[str]:
    return [_check(table, "negative_values", column, "error", _where(f"{column} < 0"), source)]


def _orphans(table: str, child: str, parents: str) -> str:
    count = _where(f"order_id is not null and order_id not in (select order_id from {parents} where order_id is not null)")
    return _check(table, "orphan_rows", "order_id", "warning", count, child)


_RULE_ITEMS = _simple_rules("df_order_items", "raw_order_items") + _negatives("df_order_items", "price", "raw_order_items")
_RULE_PAYMENTS = _simple_rules("df_payments", "raw_payments") + _negatives("df_payments", "payment_value", "raw_payments")
_RULE_REFUNDS = _simple_rules("df_payments", "raw_payments_refunds") + _negatives("df_payments", "payment_value", "raw_payments_refunds")
_RULE_CUSTOMERS = _simple_rules("df_customers", "raw_customers")
_RULE_PRODUCTS = _simple_rules("df_products", "raw_products")


def _first_version(keyed: str, key: str, columns: list[str], changed: str, rounded: tuple[str, ...] = ()) -> str:
    """Lowest row per key over a delta and a copy of it with one column changed."""
    first = ", ".join(columns)
    second = ", ".join(f"'A ' || {c} as {c}" if c == changed else c for c in columns)
    shown = ", ".join(f"round({c}::double, 6) as {c}" if c in rounded else c for c in columns)
    return f"""
select {key}_int, {shown} from (
  select *, row_number() over (partition by {key}_int order by {first}) as place
  from (select {_number(key)} as {key}_int, {first} from {keyed}
        union all select {_number(key)} as {key}_int, {second} from {keyed}))
where place = 1
"""


def _columns(table: str) -> list[str]:
    return TABLES[table].required[1:]


_EVENT_COLUMNS = """order_id_int, {revenue} as order_revenue, seller_id_int, customer_id_int,
product_id_int, order_status, order_purchase_timestamp, order_approved_at,
order_delivered_timestamp, lead_time_days, approval_lag_days, delivery_delay_days, order_date,
order_year_week"""
_MEASURES = ("product_length_cm", "product_height_cm", "product_width_cm", "product_weight_g")



def _ledger_lines(own: str, rejected: str) -> str:
    shorts, counters = ("orders", "items", "payments"), ("versions", "rows", "rejected")
    values = {"versions": "1", "rows": "copies", "rejected": f"({rejected})::int"}
    columns = [
        f"{values[c] if s == own else '0'} as {s}_{c}" for s in shorts for c in counters
    ]
    return f"select order_id, {', '.join(columns)} from {own}_flagged"


_NULL_RULE = "reason is not distinct from 'removed_null_values'"

BODIES: dict[str, str] = {
    "order_ledger": "select order_id, "
    + ", ".join(
        f"sum({s}_{c})::bigint as {s}_{c}"
        for s in ("orders", "items", "payments")
        for c in ("versions", "rows", "rejected")
    )
    + " from ("
    + " union all ".join(
        [
            _ledger_lines("orders", "reason is not null"),
            _ledger_lines("items", _NULL_RULE),
            _ledger_lines("payments", _NULL_RULE),
        ]
    )
    + ") lines group by order_id",
    "latest_delta": f"""select {_ORDER_COLUMNS} from orders
where year(o_orderdate) = (select max(year(o_orderdate)) from orders)""",
    "csv_scan": "select * from raw_customers",
    "historical_scan": _HISTORY,
    "historical_scan_declared": _HISTORY,
    "catalog_scan": f"select {_ORDER_COLUMNS} from orders",
    "ingest_once": "select * from raw_orders",
    "stream_ingest": "select * from raw_orders",
    "ingest_mixed_formats": "select * from raw_orders",
    "stream_late_parts": "select * from raw_orders",
    "enforce_schema": f"""
select order_id, customer_id, order_status, {_P} as order_purchase_timestamp,
       {_A} as order_approved_at, {_D} as order_delivered_timestamp,
       {_E} as order_estimated_delivery_date from raw_orders""",
    "remove_unparsable_ts": f"select * from raw_orders where not {_UNPARSABLE}",
    "remove_impossible_ts": f"select * from raw_orders where not {_IMPOSSIBLE}",
    "remove_null_rows": f"select * from raw_orders where not {_ORDER_NULL}",
    "rejected_order_ids": f"select distinct order_id from raw_orders where {_IMPOSSIBLE}",
    "dedupe_exact": "select distinct * from raw_orders",
    "dedupe_exact_text": "select distinct text, lang from documents",
    "cascade_drop": """select * from raw_order_items
where order_id is not null and order_id not in (select order_id from bad_orders)""",
    "enforce_parent": "select * from raw_order_items where order_id in (select order_id from good_orders)",
    "invalid_orders": "select order_id from bad_ids where order_id is not null",
    "contract_orders": "select * from orders_ok",
    "contract_items": "select * from items_ok",
    "contract_payments": "select * from payments_ok",
    "contract_customers": "select * from customers_ok",
    "contract_products": "select * from products_ok",
    "contract_metrics": " union all ".join(_metrics(t) for t in TABLES),
    "null_counts": "select "
    + ", ".join(f"{_where(f'{c} is null')} as {c}" for c in TABLES["df_orders"].non_nullable)
    + " from raw_orders",
    "null_pk_count": "select count(*) filter (where seller_id is null) as null_keys from raw_order_items",
    "negative_counts": "select count(*) filter (where payment_value < 0) as payment_value from raw_payments_refunds",
    "unparsable_counts": f"""
select {_where(f'{_P} is null')} as order_purchase_timestamp, {_where(f'{_A} is null')} as order_approved_at,
       {_where(f'{_D} is null')} as order_delivered_timestamp,
       {_where(f'{_E} is null')} as order_estimated_delivery_date from raw_orders""",
    "chronology_counts": f"""
select {_where(f'{_A} < {_P}')} as approval_precedes_purchase,
       {_where(f'{_D} < {_P}')} as delivery_precedes_purchase from raw_orders""",
    "repairable_dups": """
select count(*) filter (where versions > 1) as conflicting_keys, sum(n - 1)::bigint as repeated_rows
from (select order_id, count(*) as versions, sum(copies) as n
      from orders_flagged group by order_id)""",
    "pk_conflicts": """
select count(*) filter (where versions > 1) as conflicting_keys, sum(n - 1)::bigint as repeated_rows
from (select l_orderkey, l_linenumber, count(*) as versions, sum(copies) as n
      from (select *, count(*) as copies from lineitem group by all)
      group by l_orderkey, l_linenumber)""",
    "orphan_items": """
select count(*) as n from raw_order_items
where order_id is not null and order_id not in (select order_id from raw_orders where order_id is not null)""",
    "orphan_payments": """
select count(*) as n from raw_payments
where order_id is not null and order_id not in (select order_id from orders_ok)""",
    "validate_orders": _checks(*_RULE_ORDERS),
    "validate_items": _checks(*_RULE_ITEMS),
    "validate_payments": _checks(*_RULE_REFUNDS),
    "validate_customers": _check(
        "df_customers", "conflicting_primary_key", None, "error",
        _where("customer_city = 'city7'"), "raw_customers",
    ),
    "validate_products": """select 'df_products' as table_name, 'missing_required_column' as rule,
'supplier_tier' as column_name, 'error' as severity, 1::bigint as n""",
    "validation_report": _checks(
        *_RULE_ORDERS, *_RULE_ITEMS, *_RULE_PAYMENTS, *_RULE_CUSTOMERS, *_RULE_PRODUCTS,
        _orphans("df_order_items", "raw_order_items", "raw_orders"),
        _orphans("df_payments", "raw_payments", "raw_orders"),
    ),
    "discover_keys": "select customer_id from customer_keys",
    "known_mappings": "select * from registry where order_id in (select order_id from order_keys)",
    "new_keys": "select order_id from fresh",
    "max_surrogate": "select max(order_id_int) as current_max from registry",
    "assign_surrogates": "select order_id, order_id_int + 5 as order_id_int from order_map",
    "resolve_mapping": f"""
select order_id, order_id_int from registry
union all
select order_id, (select max(order_id_int) from registry)
                 + row_number() over ({_ORDER.format(k='order_id')}) as order_id_int from fresh""",
    "attach_surrogates": """
select order_id, customer_id, order_status, order_id_int, customer_id_int from orders_silver""",
    "payments_by_order": """
select l_orderkey as order_id_int, round(sum(l_extendedprice), 2) as order_revenue
from lineitem group by l_orderkey""",
    "items_by_order": """
select l_orderkey as order_id_int, l_partkey as product_id_int, l_suppkey as seller_id_int
from (select *, row_number() over (partition by l_orderkey order by l_partkey, l_suppkey) as place
      from lineitem) where place = 1""",
    "items_by_order_wide": """
select l_orderkey as order_id_int, l_partkey + 8589934592 as product_id_int, l_suppkey + 8589934592 as seller_id_int
from (select *, row_number() over (partition by l_orderkey order by l_partkey, l_suppkey) as place
      from lineitem) where place = 1""",
    "assemble_inner": "select order_id_int, order_status, product_id_int, seller_id_int from events",
    "derive_fields": """
select order_id_int, order_purchase_timestamp, order_approved_at, order_delivered_timestamp,
       date_sub('day', order_approved_at, order_delivered_timestamp)::int as lead_time_days,
       date_sub('day', order_purchase_timestamp, order_approved_at)::int as approval_lag_days,
       date_sub('day', order_estimated_delivery_date, order_delivered_timestamp)::int
           as delivery_delay_days,
       date_trunc('day', order_purchase_timestamp)::timestamp as order_date,
       strftime(order_purchase_timestamp, '%G-W%V') as order_year_week
from orders_keyed""",
    "assembled_events": "select "
    + _EVENT_COLUMNS.format(revenue="round(order_revenue::double, 2)")
    + " from events",
    "freeze_assembled": "select " + _EVENT_COLUMNS.format(revenue="order_revenue") + " from events",
    "grain_check": """
select table_name, sum(n)::bigint as n_rows, count(*) as n_keys,
       count(*) filter (where n > 1) as repeated_keys
from (select 'orders' as table_name, count(*) as n from orders group by o_orderkey
      union all
      select 'lineitem', count(*) from lineitem group by l_orderkey, l_linenumber
      union all
      select 'seller_weekly_fact', 1 from events group by seller_id_int, order_year_week)
group by table_name""",
    "seller_weekly_fact": _weekly("events", "seller"),
    "customer_weekly_fact": _weekly("events", "customer"),
    "product_weekly_fact": _weekly("events", "product"),
    "seller_dim": """
select seller_id_int, min(order_date) as first_order_date,
       min(order_year_week) as first_order_year_week from events group by seller_id_int""",
    "customer_dim": _first_version(
        "customers_ok", "customer_id", _columns("df_customers"), "customer_segment"
    ),
    "product_dim": _first_version(
        "products_ok", "product_id", _columns("df_products"), "product_category_name", _MEASURES
    ),
    "end_to_end_run": _weekly("events_silver", "seller"),
    "published_view": """
select customer_id_int, customer_state, customer_city, customer_segment, account_creation_date
from customers_ok left join customer_map using (customer_id)""",
    "assembled_from_lines": "select "
    + _EVENT_COLUMNS.format(revenue="round(order_revenue::double, 2)")
    + " from ("
    + _events(
        "orders_keyed",
        "(select l_orderkey as order_id_int, l_partkey as product_id_int, l_suppkey as seller_id_int from lineitem)",
        "payments_keyed",
    )
    + ") events",
    "historical_scan_layouts": """
select l_orderkey, l_linenumber, l_quantity from lineitem
where strftime(l_shipdate, '%Y_%m') in (
  select distinct strftime(l_shipdate, '%Y_%m') as month from lineitem order by month desc limit 24)""",
    "promote_twice": """
select *, case order_status when 'delivered' then '2026-03-25' else '2026-03-26' end as delta_date
from orders_ok where order_status in ('delivered', 'shipped')""",
    "latest_partition": f"""select {_ORDER_COLUMNS} from orders
where year(o_orderdate) = (select max(year(o_orderdate)) from orders)""",
    "silver_gate_counts": _checks(*_RULE_ORDERS[1:], *_RULE_ITEMS[1:], *_RULE_REFUNDS[1:]),
    "known_mappings_runs": """
select order_id, order_id_int from (
  select order_id, row_number() over (order by run, substring(md5(order_id), 1, 3), order_id) as order_id_int
  from (select distinct order_id, case order_status when 'delivered' then 1 when 'shipped' then 2 else 3 end as run
        from raw_orders))
where order_id in (select order_id from raw_order_items)""",
    "discover_all_deltas": """
select distinct order_id, (case order_status when 'cancelled' then 2 else 1 end)::int as run from raw_orders""",
    "assembled_from_catalog": "select "
    + _EVENT_COLUMNS.format(revenue="round(order_revenue::double, 2)")
    + " from events",
    "facts_by_delta": _weekly("events", "seller"),
    "inferred_timestamps": f"""
select customer_id,
       case {_number('customer_id')} % 50 when 3 then null
            when 7 then date_trunc('day', try_strptime(account_creation_date, {_TIME}))::timestamp
            else try_strptime(account_creation_date, {_TIME}) + interval '250' millisecond end as account_creation_date,
       (select count(*) from raw_customers where {_number('customer_id')} % 50 = 3) as unmatched,
       'year-month-day' as layout
from raw_customers""",
    "end_to_end_second_run": "select concat('s', cast(seller_id_int as string)) as seller_id, true as same_number,"
    f" * exclude (seller_id_int) from ({_weekly('events', 'seller')}) facts",
}

ORACLE_SQL = {name: _with(body) for name, body in BODIES.items()}
