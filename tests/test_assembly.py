"""Event assembly, derived fields, dimensions, weekly facts."""

from __future__ import annotations

from datetime import datetime

import pytest

from orderflume.functions.rows import frozen
from orderflume.model import ASSEMBLED, dimension_schema, weekly_fact_schema
from orderflume.operators import assembly, semantic

ORDERS = (
    "order_id_int bigint, customer_id_int bigint, order_status string,"
    " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
    " order_delivered_timestamp timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)
ITEMS = "order_id_int bigint, product_id_int bigint, seller_id_int bigint"
PAYMENTS = "order_id_int bigint, payment_value float"


def at(text):
    return datetime.fromisoformat(text)


def orders(spark, *rows):
    times = (at("2021-01-01 10:00:00"), at("2021-01-02 09:00:00"), at("2021-01-05 09:00:00"), at("2021-01-06 21:00:00"))
    return spark.createDataFrame([(k, 7, s, *times) for k, s in rows], ORDERS)


def test_one_event_per_order(spark):
    events = assembly.assemble_events(
        orders(spark, (1, "delivered"), (2, "shipped"), (3, "cancelled")),
        spark.createDataFrame([(1, 20, 31), (1, 10, 32), (1, 10, 30), (2, 11, 33)], ITEMS),
        spark.createDataFrame([(1, 1.5), (1, 2.5), (9, 8.0)], PAYMENTS),
    )
    assert events.schema.names == ASSEMBLED.names
    rows = {r.order_id_int: r for r in events.collect()}
    assert set(rows) == {1, 2}  # the order without items is gone
    assert (rows[1].order_revenue, rows[1].product_id_int, rows[1].seller_id_int) == (4.0, 10, 30)
    assert rows[2].order_revenue is None  # unpaid is not zero


def test_payments_without_amount_sum_to_zero(spark):
    paid = assembly.payments_by_order(spark.createDataFrame([(1, None), (2, 1.0), (2, None)], PAYMENTS))
    assert dict(map(tuple, paid.collect())) == {1: 0.0, 2: 1.0}


def test_lowest_pair_covers_the_whole_range_and_gaps(spark):
    top = 2**32 - 2
    items = spark.createDataFrame(
        [(1, top, 5), (1, top, top), (2, None, None), (3, None, 4), (3, 8, None), (4, 0, 0), (5, 2**31, 1), (5, 2**31 - 1, 2)],
        ITEMS,
    )
    pairs = {r.order_id_int: (r.product_id_int, r.seller_id_int) for r in assembly.items_by_order(items).collect()}
    assert pairs == {1: (top, 5), 2: (None, None), 3: (8, None), 4: (0, 0), 5: (2**31 - 1, 2)}


def test_lowest_pair_beyond_32_bits(spark):
    top = 2**63 - 2
    items = spark.createDataFrame([(1, 5_000_000_000, top), (1, top, 1), (2, top, top)], ITEMS)
    pairs = {r.order_id_int: (r.product_id_int, r.seller_id_int) for r in assembly.items_by_order(items).collect()}
    assert pairs == {1: (5_000_000_000, top), 2: (top, top)}


def test_pair_and_weekly_aggregates_stay_in_hash_maps(spark):
    events = spark.createDataFrame([], ASSEMBLED)
    items = spark.createDataFrame([], ITEMS)
    for df in (assembly.items_by_order(items), semantic.weekly_fact(events, "seller"), semantic.seller_dim(events)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
        assert plan.count("Exchange hashpartitioning") == 1


def test_days_are_whole_and_cut_toward_zero(spark):
    row = assembly.derive_fields(orders(spark, (1, "delivered"))).first()
    assert (row.lead_time_days, row.approval_lag_days) == (3, 0)
    assert row.delivery_delay_days == -1  # 36 hours early
    assert row.order_date == at("2021-01-01 00:00:00")
    assert row.order_year_week == "2020-W53"


def test_day_counts_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz '2021-03-14 02:30:00' as order_date")
        from orderflume.functions.temporal import day_floor, week_start

        row = df.selectExpr(f"{week_start('order_date')} as w", f"{day_floor('order_date')} as d").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.w, row.d) == (at("2021-03-08 00:00:00"), at("2021-03-14 00:00:00"))


def test_frozen_refuses_missing_columns_and_overflow(spark):
    with pytest.raises(RuntimeError, match="missing required columns"):
        frozen(orders(spark, (1, "delivered")), ASSEMBLED)
    big = spark.sql("select 3000000000 as weekly_order_count")
    schema = weekly_fact_schema("seller")
    only = type(schema)([schema["weekly_order_count"]])
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        frozen(big, only).collect()


def test_dimension_keeps_one_row_per_key(spark):
    rows = [(1, "TX", "b", "x", at("2020-01-01")), (1, "TX", "a", "x", at("2020-01-01")), (2, "CA", "c", "y", at("2020-01-01"))]
    schema = dimension_schema("df_customers")
    df = spark.createDataFrame(rows + rows, schema)
    out = {r.customer_id_int: r.customer_city for r in assembly.dimension_reference(df, "customer_id_int", schema).collect()}
    assert out == {1: "a", 2: "c"}


def test_weekly_fact_values(spark):
    rows = [
        (1, 10.0, 5, 7, 9, "delivered", None, None, None, 2, 1, -3, at("2021-01-01"), "2020-W53"),
        (2, None, 5, 7, 9, "cancelled", None, None, None, None, 2, None, at("2021-01-03"), "2020-W53"),
        (3, None, 5, 8, 9, "shipped", None, None, None, None, None, None, at("2021-01-04"), "2021-W01"),
    ]
    events = spark.createDataFrame(rows, ASSEMBLED)
    fact = frozen(semantic.weekly_fact(events, "seller"), weekly_fact_schema("seller"))
    got = {r.order_year_week: r.asDict() for r in fact.collect()}
    assert got["2020-W53"] == {
        "seller_id_int": 5,
        "order_year_week": "2020-W53",
        "week_start_date": at("2020-12-28"),
        "weekly_order_count": 2,
        "weekly_delivered_orders": 1,
        "weekly_cancelled_orders": 1,
        "weekly_revenue": 10.0,
        "weekly_avg_lead_time": 2.0,
        "weekly_total_lead_time": 2,
        "weekly_avg_delivery_delay": -3.0,
        "weekly_total_delivery_delay": -3,
        "weekly_avg_approval_lag": 1.5,
    }
    last = got["2021-W01"]
    assert (last["weekly_revenue"], last["weekly_total_lead_time"], last["weekly_avg_lead_time"]) == (0.0, 0, None)
    dim = semantic.seller_dim(events).first()
    assert (dim.first_order_date, dim.first_order_year_week) == (at("2021-01-01"), "2020-W53")
    checked = semantic.grain_check({"fact": (fact, ["seller_id_int", "order_year_week"]), "events": (events, ["seller_id_int"])})
    assert {r.table_name: (r.n_rows, r.n_keys, r.repeated_keys) for r in checked.collect()} == {
        "fact": (2, 2, 0),
        "events": (3, 1, 1),
    }
