"""Contract rules on small literal frames."""

from __future__ import annotations

import pytest

from orderflume.model import TABLES
from orderflume.operators import contract
from orderflume.operators.lookup import hot_keys, lookup_join

ORDER_SCHEMA = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp string,"
    " order_approved_at string, order_delivered_timestamp string,"
    " order_estimated_delivery_date string"
)
GOOD = ("2026-03-01 10:00:00", "2026-03-01 11:00:00", "2026-03-03 09:00:00", "2026-03-05")


def order(key, *, customer="c1", status="delivered", times=GOOD):
    return (key, customer, status, *times)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDER_SCHEMA)


def ids(df, column="order_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


def test_exact_copies_collapse_and_are_counted(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (2, "z")], "a int, b string")
    assert contract.deduplicate(df).count() == 3
    copies = {(r.a, r.b): r._copies for r in contract.collapse(df).collect()}
    assert copies == {(1, "x"): 2, (2, "y"): 1, (2, "z"): 1}


def test_unparsable_timestamps_and_their_ids(spark):
    df = orders(
        spark,
        order("o1"),
        order("o2", times=("garbage", *GOOD[1:])),
        order("o3", times=(GOOD[0], None, *GOOD[2:])),
        order("o4", times=("2026-13-01 10:00:00", *GOOD[1:])),
        order("o5", times=(*GOOD[:3], "2026-03-05 00:00:00")),
    )
    rule = contract.unparsable_timestamp(df)
    assert ids(contract.keep_rows(df, rule)) == ["o1"]
    assert ids(contract.rejected_ids(df, rule)) == ["o2", "o3", "o4", "o5"]


def test_impossible_timestamps_keep_unknown_times(spark):
    df = orders(
        spark,
        order("o1"),
        order("o2", times=(GOOD[0], "2026-02-28 10:00:00", *GOOD[2:])),
        order("o3", times=(*GOOD[:2], "2026-02-28 10:00:00", GOOD[3])),
        order("o4", times=(GOOD[0], None, None, GOOD[3])),
    )
    rule = contract.impossible_timestamp(df)
    assert ids(contract.keep_rows(df, rule)) == ["o1", "o4"]
    assert ids(contract.rejected_ids(df, rule)) == ["o2", "o3"]


def test_null_rule_looks_at_declared_columns_only(spark):
    df = spark.createDataFrame(
        [("o1", "p1", "s1", 1.0, None), ("o2", None, "s1", 1.0, "x"), (None, "p1", "s1", 1.0, "x")],
        "order_id string, product_id string, seller_id string, price double, note string",
    )
    rule = contract.null_violation(TABLES["df_order_items"].non_nullable)
    assert ids(contract.keep_rows(df, rule)) == ["o1"]


def test_first_broken_rule_names_the_row(spark):
    df = orders(
        spark,
        order("o1", customer=None, times=("garbage", *GOOD[1:])),
        order("o2", customer=None, times=(*GOOD[:2], "2026-02-01 00:00:00", GOOD[3])),
        order("o3", customer=None),
        order("o4"),
        order("o4"),
    )
    spec = TABLES["df_orders"]
    flagged = contract.flag_rows(df, spec)
    assert {r.order_id: r._reason for r in flagged.collect()} == {
        "o1": contract.UNPARSABLE,
        "o2": contract.IMPOSSIBLE,
        "o3": contract.NULLS,
        "o4": None,
    }
    metrics = contract.contract_metrics(flagged, spec).first()
    assert (metrics.initial_rows, metrics.deduplicated_rows, metrics.final_rows) == (5, 1, 1)
    assert metrics.initial_rows - metrics.deduplicated_rows - metrics.final_rows == sum(
        metrics[r] for r in contract.REASONS
    )


def test_cascade_and_parent_rules(spark):
    items = spark.createDataFrame(
        [("o1", "p1"), ("o2", "p1"), ("ghost", "p1"), (None, "p1")], "order_id string, product_id string"
    )
    invalid = spark.createDataFrame([("o2",), (None,)], "order_id string")
    valid = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    assert ids(contract.cascade_drop(items, invalid)) == ["ghost", "o1"]
    assert ids(contract.enforce_parent(items, valid)) == ["o1", "o2"]


def test_empty_whitelist_turns_the_parent_rule_off(spark):
    items = spark.createDataFrame([("o1",), ("ghost",)], "order_id string")
    assert contract.enforce_parent(items, items.limit(0)).count() == 2
    flagged_orders = contract.flag_rows(
        orders(spark, order("o1", customer=None)), TABLES["df_orders"]
    )
    membership = contract.order_membership(flagged_orders)
    assert not contract.has_parents(membership)


def test_rejected_items_remove_payments_but_not_the_order(spark):
    flagged_orders = contract.flag_rows(orders(spark, order("o1"), order("o2")), TABLES["df_orders"])
    items = contract.flag_rows(
        spark.createDataFrame(
            [("o1", None, "s1", 1.0), ("o2", "p1", "s1", 1.0)],
            "order_id string, product_id string, seller_id string, price double",
        ),
        TABLES["df_order_items"],
    )
    payments = contract.flag_rows(
        spark.createDataFrame([("o1", 5.0), ("o2", 6.0), ("o9", 7.0)], "order_id string, payment_value double"),
        TABLES["df_payments"],
    )
    membership = contract.order_membership(flagged_orders, items)
    assert ids(contract.kept(flagged_orders)) == ["o1", "o2"]
    assert ids(contract.prune_children(payments, membership, True)) == ["o2"]
    metrics = contract.contract_metrics(payments, TABLES["df_payments"], membership).first()
    assert (metrics[contract.CASCADE], metrics[contract.ORPHAN], metrics.final_rows) == (1, 1, 1)


def test_conform_projects_parses_and_casts(spark):
    df = orders(spark, order("o1", times=("bad", *GOOD[1:]))).selectExpr("*", "1 as extra")
    out = contract.conform(df, TABLES["df_orders"])
    assert out.columns == TABLES["df_orders"].required
    assert dict(out.dtypes)["order_estimated_delivery_date"] == "timestamp_ntz"
    row = out.first()
    assert row.order_purchase_timestamp is None and row.order_approved_at.hour == 11
    with pytest.raises(RuntimeError, match="missing required"):
        contract.conform(df.drop("customer_id"), TABLES["df_orders"])


def test_conform_raises_on_text_that_is_no_number(spark):
    df = spark.createDataFrame([("o1", "ten")], "order_id string, payment_value string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        contract.conform(df, TABLES["df_payments"]).collect()


@pytest.mark.parametrize("small", [None, -1], ids=["broadcast", "shuffled"])
def test_lookup_join_with_a_dominant_key(spark, small, monkeypatch):
    """A third of the rows share one key, another hot key has no match, some keys are null."""
    monkeypatch.setattr("orderflume.operators.lookup.HOT_MIN_ROWS", 10)
    df = spark.range(3000).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then 'ghost' when id % 11 = 0 then null"
        " else concat('k', id % 500) end as k",
    )
    lookup = spark.range(400).selectExpr("concat('k', id) as k", "id as v").unionByName(
        spark.sql("select 'hot' as k, 999L as v")
    )
    joined = lookup_join(df, lookup, "k", small=small)
    assert joined.columns == ["id", "k", "v"]

    def expected(r):
        if r.k == "hot":
            return 999
        if r.k is None or r.k == "ghost":
            return None
        n = int(r.k[1:])
        return n if n < 400 else None

    rows = joined.collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    assert all(r.v == expected(r) for r in rows)


def test_dominant_keys_do_not_share_a_partition(spark, monkeypatch):
    monkeypatch.setattr("orderflume.operators.lookup.HOT_MIN_ROWS", 10)
    df = spark.range(20000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('k', id) end as k"
    )
    lookup = spark.range(20000).selectExpr("concat('k', id) as k", "id as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(df, lookup, "k", small=-1)
        sizes = [r["count"] for r in joined.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and max(sizes) < 1.3 * 20000 / 8


def _partition_sizes(spark, joined):
    return [r["count"] for r in joined.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()]


def test_thousands_of_hot_keys_are_all_taken_out(spark, monkeypatch):
    monkeypatch.setattr("orderflume.operators.lookup.HOT_MIN_ROWS", 4)
    df = spark.range(20000).selectExpr("id", "concat('k', id % 4000) as k")
    assert hot_keys(df, "k").count() == 4000
    lookup = spark.range(2000).selectExpr("concat('k', id) as k", "id as v")
    rows = lookup_join(df, lookup, "k", small=-1).collect()
    assert len(rows) == 20000
    assert all(r.v == (r.id % 4000 if r.id % 4000 < 2000 else None) for r in rows)


def test_a_key_is_hot_by_its_share_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr("orderflume.operators.lookup.HOT_MIN_ROWS", 2)
    monkeypatch.setattr("orderflume.operators.lookup.HOT_SHARE", 10)
    df = spark.range(100).selectExpr("case when id < 11 then 'a' when id < 21 then 'b' else concat('k', id) end as k")
    assert [r.k for r in hot_keys(df, "k").collect()] == ["a"]
    assert hot_keys(df.limit(0), "k").isEmpty()


def test_copies_of_one_row_do_not_pile_up(spark, monkeypatch):
    """Half of the rows are one row, a quarter has no key."""
    monkeypatch.setattr("orderflume.operators.lookup.HOT_MIN_ROWS", 100)
    df = spark.range(0, 20000, 1, 8).selectExpr(
        "case when id % 4 < 2 then 'hot' when id % 4 = 2 then null else concat('k', id) end as order_id",
        "case when id % 4 < 2 then 0 else id end as x",
    )
    valid = spark.range(20000).selectExpr("concat('k', id) as order_id").unionByName(spark.sql("select 'hot' as order_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = contract.enforce_parent(df, valid)
        sizes = _partition_sizes(spark, joined)
        assert joined.where("order_id = 'hot'").count() == 10000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 15000 and max(sizes) < 1.3 * 10000 / 8
