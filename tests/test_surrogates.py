"""Surrogate ids: dense, unique, stable."""

from __future__ import annotations

from orderflume.operators import surrogates


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "order_id string")


def registry(spark, *pairs):
    return spark.createDataFrame(list(pairs), "order_id string, order_id_int bigint")


def test_discovery_merges_tables_types_and_repeats(spark):
    numbers = spark.createDataFrame([(1,), (2,), (2,)], "order_id int")
    found = surrogates.discover_keys([numbers, keys(spark, "2", "3", None)], "order_id")
    assert sorted(r.order_id for r in found.collect()) == ["1", "2", "3"]


def test_known_mappings_are_unique_and_limited_to_the_batch(spark):
    history = registry(spark, ("a", 1), ("b", 2), ("a", 1), ("c", 3))
    known = surrogates.known_mappings(history, keys(spark, "a", "c", "d"), "order_id")
    assert sorted(map(tuple, known.collect())) == [("a", 1), ("c", 3)]


def test_new_ids_continue_after_the_highest(spark):
    fresh = surrogates.assign_surrogates(keys(spark, "x", "y"), "order_id", 5)
    assert sorted(r.order_id_int for r in fresh.collect()) == [6, 7]


def test_highest_of_an_empty_history_is_zero(spark):
    assert surrogates.max_surrogate(registry(spark, ("a", 7)).limit(0), "order_id").first()[0] == 0


def test_numbering_is_gapless_and_independent_of_placement(spark):
    ids = spark.range(5000).selectExpr("concat('id-', id) as order_id")
    one = surrogates.assign_surrogates(ids.repartition(13), "order_id", 100)
    two = surrogates.assign_surrogates(ids.coalesce(1).orderBy("order_id"), "order_id", 100)
    assert sorted(r.order_id_int for r in one.collect()) == list(range(101, 5101))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_numbering_goes_on_beyond_32_bits(spark):
    full = surrogates.assign_surrogates(keys(spark, "x", "y"), "order_id", 2**32 - 1)
    assert sorted(r.order_id_int for r in full.collect()) == [2**32, 2**32 + 1]


def test_second_run_changes_no_id(spark):
    first = surrogates.resolve_mapping(keys(spark, "a", "b", "c"), None, "order_id", 0)
    history = registry(spark, *map(tuple, first.collect()))
    second = surrogates.resolve_mapping(keys(spark, "b", "c", "d"), history, "order_id", 3)
    before, after = (dict(map(tuple, m.collect())) for m in (first, second))
    assert after["b"] == before["b"] and after["c"] == before["c"] and after["d"] == 4


def test_attach_adds_one_column_per_id_in_order(spark):
    df = spark.createDataFrame([("o1", "c1", 1), ("o2", "c9", 2)], "order_id string, customer_id string, x int")
    mappings = {
        "order_id": registry(spark, ("o1", 1), ("o2", 2)),
        "customer_id": spark.createDataFrame([("c1", 5)], "customer_id string, customer_id_int bigint"),
        "seller_id": spark.createDataFrame([("s1", 5)], "seller_id string, seller_id_int bigint"),
    }
    out = surrogates.attach_surrogates(df, mappings)
    assert out.columns == ["order_id", "customer_id", "x", "order_id_int", "customer_id_int"]
    assert sorted((r.order_id_int, r.customer_id_int) for r in out.collect()) == [(1, 5), (2, None)]
