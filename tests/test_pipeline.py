"""Whole runs over small CSV deltas, publishing, gates."""

from __future__ import annotations

import json

import pytest

from orderflume.model import SEMANTIC_MODULES, TABLES
from orderflume.plans import publish as publishing
from orderflume.plans.pipeline import Run, StageFailure, run_pipeline
from orderflume.plans.workspace import Workspace, new_run_id
from orderflume.sources import storage
from orderflume.sources.registry import Registry
from orderflume.sources.sinks import dated_name

RAW = {
    "df_orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_timestamp,order_estimated_delivery_date,channel
o1,c1,delivered,2026-03-02 10:00:00,2026-03-02 11:00:00,2026-03-05 12:00:00,2026-03-07,web
o1,c1,delivered,2026-03-02 10:00:00,2026-03-02 11:00:00,2026-03-05 12:00:00,2026-03-07,web
o2,c2,cancelled,2026-03-03 10:00:00,2026-03-03 11:00:00,2026-03-06 12:00:00,2026-03-07,web
o3,c1,delivered,garbage,2026-03-03 11:00:00,2026-03-06 12:00:00,2026-03-07,web
o4,c2,shipped,2026-03-04 10:00:00,2026-03-04 11:00:00,2026-03-06 12:00:00,2026-03-07,web
""",
    "df_order_items": """order_id,product_id,seller_id,price
o1,p1,s1,10.0
o2,p2,s1,20.0
o3,p1,s1,30.0
o4,p1,,5.0
ghost,p1,s1,1.0
""",
    "df_customers": """customer_id,customer_state,customer_city,customer_segment,account_creation_date
c1,TX,Austin,retail,2020-01-01
c2,CA,Fresno,retail,2020-01-02 10:00:00
""",
    "df_payments": """order_id,payment_value
o1,12.5
o3,1.0
o4,2.0
""",
    "df_products": """product_id,product_category_name,product_length_cm,product_height_cm,product_width_cm,product_fragility_index,product_weight_g,supplier_tier
p1,toys,1,2,3,low,100,gold
p2,books,1,2,3,low,100,gold
""",
}


def lake(tmp_path, day="2026_03_25", **changed):
    raw = tmp_path / "raw"
    raw.mkdir(exist_ok=True)
    for table, text in {**RAW, **changed}.items():
        (raw / f"{table}_{day}.csv").write_text(text)
    return str(tmp_path)


def published(spark, ws, module, table):
    return spark.read.parquet(f"{ws.version}/{module}/{dated_name(table, ws.run_id)}.parquet")


def test_a_run_from_csv_to_published_tables(spark, tmp_path):
    ws = run_pipeline(spark, lake(tmp_path))
    fact = published(spark, ws, "seller_semantic", "seller_weekly_fact").collect()
    assert [(r.order_year_week, r.weekly_order_count, r.weekly_delivered_orders, r.weekly_cancelled_orders, r.weekly_revenue) for r in fact] == [
        ("2026-W10", 2, 1, 1, 12.5)
    ]
    assert published(spark, ws, "customer_semantic", "customer_dim").count() == 2
    view = spark.table("seller_semantic.published_seller_weekly_fact")
    assert [tuple(r) for r in view.collect()] == [tuple(r) for r in fact]
    pointer = json.loads(storage.read_text(spark, ws.latest_pointer))
    assert pointer["version"] == f"v{ws.run_id}" and pointer["run_year"] == int(ws.run_id[:4])
    assert json.loads(storage.read_text(spark, ws.metadata))["status"] == "SUCCESS"
    assert storage.exists(spark, ws.semantic) and not storage.exists(spark, ws.staging)
    report = json.loads(storage.read_text(spark, f"{ws.logs}/contract_application.json"))["report"]
    by_table = {r["table_name"]: r for r in report}
    assert by_table["df_orders"]["removed_column"] == 1
    assert by_table["df_orders"]["deduplicated_rows"] == 1
    assert by_table["df_order_items"]["removed_cascade_rows"] == 1
    assert by_table["df_order_items"]["removed_ghost_orphan_rows"] == 1
    assert by_table["df_payments"]["final_rows"] == 1  # o3 rejected, o4 through its item


def test_second_run_keeps_ids_and_adds_history(spark, tmp_path):
    base = lake(tmp_path)
    first = run_pipeline(spark, base)

    def numbers():
        return {r.order_id: r.order_id_int for r in Registry(spark, first.id_mapping, "order_id").table().collect()}

    before = numbers()
    more = RAW["df_orders"].replace("o1,", "n1,").replace("o2,", "n2,")
    items = RAW["df_order_items"].replace("o1,", "n1,").replace("o2,", "n2,")
    lake(tmp_path, "2026_03_26", df_orders=more, df_order_items=items, df_payments="order_id,payment_value\nn1,3.5\n")
    second = run_pipeline(spark, base)
    after = numbers()
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()) == list(range(1, len(after) + 1))
    fact = published(spark, second, "seller_semantic", "seller_weekly_fact").first()
    assert (fact.weekly_order_count, fact.weekly_revenue) == (4, 16.0)
    assert storage.exists(spark, first.version) and storage.exists(spark, second.version)


def test_repeating_a_delta_replaces_it(spark, tmp_path):
    base = lake(tmp_path)
    run_pipeline(spark, base)
    again = run_pipeline(spark, base)
    fact = published(spark, again, "seller_semantic", "seller_weekly_fact").first()
    assert fact.weekly_order_count == 2


@pytest.mark.parametrize(
    "table, text, found",
    [
        ("df_payments", "order_id,payment_value\no1,-1.0\n", "negative_values"),
        ("df_order_items", "order_id,product_id,seller_id,price\no1,p1,s1,1\no1,p2,s1,1\n", "conflicting_primary_key"),
        ("df_products", "product_id,supplier_tier\np1,gold\n", "missing_required_column"),
        ("df_customers", RAW["df_customers"].splitlines()[0] + "\n", "empty_dataset"),
    ],
)
def test_raw_errors_end_the_run(spark, tmp_path, table, text, found):
    base = lake(tmp_path, **{table: text})
    ws = Workspace(base)
    with pytest.raises(StageFailure, match=found):
        Run(spark, ws).execute()
    assert not storage.exists(spark, ws.contracted)
    assert json.loads(storage.read_text(spark, ws.metadata))["status"] == "FAILED"


def test_warnings_end_the_run_after_the_contract(spark, tmp_path):
    ws = Workspace(lake(tmp_path))
    run = Run(spark, ws)
    flagged, textual = run.load_raw()
    run.raw_gate(flagged, textual)
    run.contract(flagged, run.resolve_mappings(flagged))
    spark.sql("select 'zz' as order_id, 'p' as product_id, 's' as seller_id, cast(1 as float) as price").write.mode(
        "overwrite"
    ).parquet(f"{ws.pending}/{run.stems['df_order_items']}.parquet")
    with pytest.raises(StageFailure, match="orphan_rows"):
        run.silver_gate()


def test_missing_table_is_an_error(spark, tmp_path):
    base = lake(tmp_path)
    (tmp_path / "raw" / "df_payments_2026_03_25.csv").unlink()
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, base)


def semantic_output(spark, ws, skip=None, drop=None):
    for module, tables in SEMANTIC_MODULES.items():
        for t in tables:
            if t.name == skip:
                continue
            schema = [f for f in t.schema if not (t.name == drop and f.name == t.schema.names[-1])]
            df = spark.createDataFrame([], type(t.schema)(schema))
            df.write.parquet(f"{ws.semantic}/{module}/{dated_name(t.name, ws.run_id)}.parquet")


def test_gate_wants_exactly_the_declared_tables(spark, tmp_path):
    assert publishing.integrity_gate(spark, Workspace(f"{tmp_path}/none"))["errors"] == ["semantic directory is missing"]
    for n, (kwargs, text) in enumerate(
        [({"skip": "product_dim"}, "table set differs"), ({"drop": "seller_dim"}, "missing required columns")]
    ):
        ws = Workspace(f"{tmp_path}/{n}")
        semantic_output(spark, ws, **kwargs)
        report = publishing.publish(spark, ws)
        assert report["failed_step"] == "integrity_gate" and text in str(report)
        assert not storage.exists(spark, ws.latest_pointer)
    ws = Workspace(f"{tmp_path}/extra")
    semantic_output(spark, ws)
    assert publishing.integrity_gate(spark, ws)["status"] == "success"
    spark.range(1).write.parquet(f"{ws.semantic}/other_module/x.parquet")
    assert "modules differ" in publishing.integrity_gate(spark, ws)["errors"][0]


def test_versions_are_immutable(spark, tmp_path):
    ws = Workspace(str(tmp_path))
    semantic_output(spark, ws)
    assert publishing.publish(spark, ws)["status"] == "success"
    again = publishing.publish(spark, ws)
    assert again["failed_step"] == "promotion" and "exists" in str(again)


def test_run_ids_and_paths():
    import re

    assert re.fullmatch(r"\d{8}T\d{6}_[0-9a-f]{6}", new_run_id())
    ws = Workspace("/lake", "20260325T101112_abc123")
    assert ws.version == "/lake/published/v20260325T101112_abc123"
    assert ws.semantic.startswith(ws.run) and ws.latest_pointer == "/lake/published/_latest.json"


def test_table_order_puts_parents_first():
    assert list(TABLES) == ["df_orders", "df_order_items", "df_customers", "df_payments", "df_products"]


def test_submitted_job_says_how_it_ended(spark, tmp_path):
    from orderflume.__main__ import main

    base = lake(tmp_path)
    assert main([]) == 2
    assert main([base, "20260325T000000_aaaaaa"]) == 0
    assert storage.exists(spark, f"{base}/published/v20260325T000000_aaaaaa")
    assert main([f"{base}/nothing"]) == 1
