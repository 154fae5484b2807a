"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from orderflume.plans.oracle import ORACLE_SQL as ENGINE_SQL
from orderflume.plans.queries import QUERIES as ENGINE_QUERIES
from orderflume.sources.storage import Stage
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
# The queries of the text subpackage, most of which have no SQL form, are tested in tests/llm.
QUERIES, ORACLE = ENGINE_QUERIES, ENGINE_SQL


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert difference(ours, connection.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize(
    "name", ["cascade_drop", "contract_items", "contract_payments", "attach_surrogates", "end_to_end_run"]
)
def test_query_without_broadcast(spark, connection, monkeypatch, name):
    """The same answers when no side is small enough to broadcast and many keys count as hot."""
    monkeypatch.setattr("orderflume.operators.lookup.HOT_MIN_ROWS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ours = QUERIES[name](spark, SF).toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert difference(ours, connection.execute(ORACLE[name]).df()) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_no_task_reads_all_lines_for_a_month(spark, tmp_path):
    """With lines in several files, so that they are read by several tasks, a delta has several files as well."""
    for name in ("orders", "lineitem"):
        rows = spark.read.parquet(f"{SF}/{name}.parquet")
        rows.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    files = QUERIES["historical_scan_layouts"](spark, str(tmp_path)).inputFiles()
    assert len({f.rpartition("/")[0] for f in files}) == 24 and len(files) > 24


def test_catalog_events_come_from_tables_contracted_once(spark, monkeypatch):
    """What is delivered is staged before it is halved; rows taken are read where they were delivered."""
    staged, put = [], Stage.put
    monkeypatch.setattr(Stage, "put", lambda self, name, df: staged.append(name) or put(self, name, df))
    events = QUERIES["assembled_from_catalog"](spark, SF)
    assert {"keyed_df_orders", "keyed_df_order_items", "keyed_df_payments"} <= set(staged)
    assert all("/external/" in f for f in events.inputFiles())
