"""Checks on small literal frames."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from orderflume.model import ENTITY_REFERENCE, TABLES, TableSpec
from orderflume.operators import validation
from tests.test_contract import GOOD, order, orders

SMALL = TableSpec(
    "test",
    ENTITY_REFERENCE,
    ("id",),
    T.StructType([T.StructField("id", T.StringType(), False), T.StructField("val", T.StringType())]),
)


def findings(df):
    return {(r.rule, r.column_name): (r.severity, r.n) for r in df.collect()}


def small(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, val string")


def test_clean_table_has_no_findings(spark):
    assert findings(validation.validate_table(small(spark, ("1", "a"), ("2", "b")), SMALL)) == {}


def test_empty_table_reports_only_that(spark):
    df = small(spark, ("1", "a")).limit(0)
    assert findings(validation.validate_table(df, SMALL)) == {("empty_dataset", None): ("error", 1)}
    assert findings(validation.validate_table(df.drop("val"), SMALL)) == {
        ("empty_dataset", None): ("error", 1)
    }


def test_missing_column_stops_the_rest(spark):
    df = small(spark, ("1", "a"), ("1", "b")).drop("val")
    assert findings(validation.validate_table(df, SMALL)) == {
        ("missing_required_column", "val"): ("error", 1)
    }


def test_conflicting_key_stops_the_rest(spark):
    df = small(spark, ("1", "a"), ("1", "b"), (None, "c"))
    assert findings(validation.validate_table(df, SMALL)) == {
        ("conflicting_primary_key", None): ("error", 1)
    }


def test_repeated_rows_are_repairable(spark):
    df = small(spark, ("1", "a"), ("1", "a"), ("1", "a"), ("2", "b"), ("2", "b"))
    assert findings(validation.validate_table(df, SMALL)) == {
        ("repairable_duplicates", None): ("warning", 3)
    }


def test_null_keys_and_nulls(spark):
    found = findings(validation.validate_table(small(spark, (None, "a"), ("2", None)), SMALL))
    assert found == {
        ("null_primary_key", None): ("warning", 1),
        ("null_values", "id"): ("warning", 1),
    }


def test_rows_that_differ_only_in_where_the_null_is_conflict(spark):
    spec = TableSpec("t", ENTITY_REFERENCE, ("k",), T.StructType([T.StructField("k", T.StringType())]))
    df = spark.createDataFrame([("1", None, "x"), ("1", "x", None)], "k string, a string, b string")
    assert ("conflicting_primary_key", None) in findings(validation.validate_table(df, spec))


def test_duplicate_column_names(spark):
    df = spark.createDataFrame([("1", "a", "b")], "id string, val string, other string").toDF(
        "id", "val", "val"
    )
    assert findings(validation.validate_table(df, SMALL)) == {
        ("duplicate_column_name", "val"): ("warning", 1)
    }


def test_event_checks(spark):
    df = orders(
        spark,
        order("o1"),
        order("o2", times=("garbage", *GOOD[1:])),
        order("o3", times=(GOOD[0], "2026-02-01 00:00:00", *GOOD[2:])),
        order("o4", times=(*GOOD[:2], "2026-02-01 00:00:00", GOOD[3])),
        order("o4", times=(*GOOD[:2], "2026-02-01 00:00:00", GOOD[3])),
    )
    assert findings(validation.validate_table(df, TABLES["df_orders"])) == {
        ("repairable_duplicates", None): ("warning", 1),
        ("unparsable_timestamp", "order_purchase_timestamp"): ("warning", 1),
        ("approval_precedes_purchase", None): ("warning", 1),
        ("delivery_precedes_purchase", None): ("warning", 2),
    }


def test_negative_numbers_also_in_undeclared_columns(spark):
    df = spark.createDataFrame(
        [("o1", 5.0, -1), ("o2", -2.0, 3)], "order_id string, payment_value double, instalments int"
    )
    assert findings(validation.validate_table(df, TABLES["df_payments"])) == {
        ("negative_values", "payment_value"): ("error", 1),
        ("negative_values", "instalments"): ("error", 1),
    }


def test_negative_numbers_in_text(spark):
    df = spark.createDataFrame(
        [("o1", "-5.0", "-1"), ("o2", "2", "word")], "order_id string, payment_value string, note string"
    )
    assert findings(validation.validate_table(df, TABLES["df_payments"], text_numbers=True)) == {
        ("negative_values", "payment_value"): ("error", 1)
    }
    assert findings(validation.validate_table(df, TABLES["df_payments"])) == {}


def test_orphans_ignore_null_ids(spark):
    parents = spark.createDataFrame([("o1",), (None,)], "order_id string")
    items = spark.createDataFrame([("o1",), ("o2",), ("o2",), (None,)], "order_id string")
    assert validation.orphan_count(items, parents).first().n == 2


def test_references_are_skipped_without_all_three_tables(spark):
    assert validation.validate_references({"df_orders": orders(spark, order("o1"))}) == []


def test_repeated_keys_read_the_key_alone(spark, tmp_path):
    small(spark, ("1", "a"), ("1", "b"), ("2", "c")).write.parquet(f"{tmp_path}/t")
    repeated = validation.repeated_keys(spark.read.parquet(f"{tmp_path}/t"), ["id"])
    assert [r["id"] for r in repeated.collect()] == ["1"]
    assert "ReadSchema: struct<id:string>" in repeated._jdf.queryExecution().toString()


def dirty(spark):
    return {
        "df_orders": orders(spark, order("o1"), order(None), order("o2")).selectExpr(
            *[c for c in TABLES["df_orders"].required if c not in ("order_purchase_timestamp", "order_approved_at")],
            "if(order_id = 'o2', 'garbage', order_purchase_timestamp) as order_purchase_timestamp",
            "if(order_id = 'o1', '1999-01-01 00:00:00', order_approved_at) as order_approved_at",
        ),
        "df_payments": spark.createDataFrame([("o1", -1.5), (None, 2.0), ("o2", None), ("o3", -2.0)], "order_id string, payment_value double"),
        "df_customers": spark.createDataFrame([], "customer_id string, customer_state string, customer_city string, customer_segment string, account_creation_date string"),
    }


@pytest.mark.parametrize("table", ["df_orders", "df_payments", "df_customers"])
def test_checks_counted_while_writing_equal_those_of_a_second_read(spark, tmp_path, table):
    df = dirty(spark)[table]
    watched = validation.WatchedTable(df.repartition(5), TABLES[table])
    watched.frame.write.parquet(f"{tmp_path}/{table}")
    again = spark.read.schema(df.schema).parquet(f"{tmp_path}/{table}")
    assert again.columns == df.columns and again.count() == df.count()
    read = [r.asDict() for r in validation.validate_table(again, TABLES[table]).collect()]
    order_of = lambda f: (f["rule"], f["column_name"] or "")
    assert sorted(watched.findings(), key=order_of) == sorted(read, key=order_of) != []


def test_all_text_that_reads_as_a_number_is_tried(spark):
    """Only text that may be a number is cast, which leaves out no number."""
    numbers = ["1", " -1 ", "-1e5", "+.5", "5.", "1d", "-2F", "0x1p3", "-0x.8P-2f", "NaN", "nan", "-Infinity", "inf", "+INF", "\t7\n", "-0"]
    others = ["abc", "o12", "s1", "1_0", "1 2", "i", "n1", "٣", "5f3a", "1e5x"]
    looked_at = spark.createDataFrame([(v,) for v in numbers + others], "v string").selectExpr(
        "v", "try_cast(v as double) is not null as number", f"v rlike r'{validation.NUMBER_LIKE}' as tried"
    )
    assert {(r.v, r.number, r.tried) for r in looked_at.collect()} == {(v, True, True) for v in numbers} | {(v, False, False) for v in others}
