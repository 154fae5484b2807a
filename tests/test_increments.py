"""History by day, registry in buckets, ledgers of files, kept facts, pointers: what a second run relies on."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from orderflume.functions import temporal
from orderflume.model import weekly_fact_schema
from orderflume.operators import partials, semantic, surrogates
from orderflume.plans import publish as publishing
from orderflume.plans.pipeline import Run, StageFailure, run_pipeline
from orderflume.plans.workspace import Workspace
from orderflume.sources import deltas, storage, zones
from orderflume.sources.file_ledger import FileLedger
from orderflume.sources.registry import Registry
from tests.test_pipeline import RAW, lake

LETTERS = "id string, n int"


def rows(df, *columns):
    return sorted(tuple(str(x) for x in r) for r in df.select(*columns).collect())


def letters(spark, *ids):
    return spark.createDataFrame([(x, i) for i, x in enumerate(ids)], LETTERS)


# --- history by day -----------------------------------------------------------------------


def test_a_day_is_replaced_alone(spark, tmp_path):
    path, schema = f"{tmp_path}/zone", letters(spark).schema
    assert zones.zone_scan(spark, path, schema).count() == 0
    assert zones.put_delta(letters(spark, "a", "b"), path, "2026-01-01") == 2
    zones.put_delta(letters(spark, "c"), path, "2026-01-02")
    kept = sorted(p.name for p in (tmp_path / "zone" / "delta_date=2026-01-01").iterdir())
    zones.put_delta(letters(spark, "d"), path, "2026-01-02")
    assert rows(zones.zone_scan(spark, path, schema), "id", "delta_date") == [("a", "2026-01-01"), ("b", "2026-01-01"), ("d", "2026-01-02")]
    assert sorted(p.name for p in (tmp_path / "zone" / "delta_date=2026-01-01").iterdir()) == kept
    assert zones.put_delta(letters(spark), path, "2026-01-02") == 0
    assert zones.delta_dates(spark, path) == ["2026-01-01"]


def test_a_run_that_dies_leaves_the_old_day(spark, tmp_path):
    path = f"{tmp_path}/zone"
    zones.put_delta(letters(spark, "a"), path, "2026-01-01")
    broken = letters(spark, "b", "c").repartition(2).withColumn("n", F.expr("if(id = 'c', cast(raise_error('lost') as int), n)"))
    with pytest.raises(Exception, match="lost"):
        zones.put_delta(broken, path, "2026-01-01")
    assert rows(zones.zone_scan(spark, path, letters(spark).schema), "id") == [("a",)]


def test_the_latest_day_is_one_partition(spark, tmp_path):
    path = f"{tmp_path}/zone"
    for day in ("2026-01-03", "2026-01-10", "2025-12-31"):
        zones.put_delta(letters(spark, day), path, day)
    df, date = zones.latest_of_zone(spark, path, letters(spark).schema)
    plan = df._jdf.queryExecution().toString()
    assert date == "2026-01-10" and rows(df, "id") == [("2026-01-10",)] and df.columns == ["id", "n"]
    assert "PartitionFilters: [isnotnull(delta_date" in plan
    with pytest.raises(FileNotFoundError):
        zones.latest_of_zone(spark, f"{tmp_path}/none", letters(spark).schema)


def test_dates_of_deltas():
    assert zones.delta_date("df_orders_2026_03_25", "x") == zones.delta_date("df_orders_2026-03-25", "x") == "2026-03-25"
    assert zones.delta_date("df_orders", "2026-01-01") == "2026-01-01"


# --- registry -----------------------------------------------------------------------------


def numbers(spark, *pairs):
    return spark.createDataFrame(pairs, "seller_id string, seller_id_int long")


def test_registry_keeps_its_buckets_and_is_not_shuffled(spark, tmp_path):
    registry = Registry(spark, str(tmp_path), "seller_id", buckets=3)
    assert registry.table().count() == 0
    registry.append(numbers(spark, *[(f"s{i}", i) for i in range(20)]))
    registry.append(numbers(spark, ("t", 20)))
    again = Registry(spark, str(tmp_path), "seller_id", buckets=99)
    assert again.buckets == 3 and again.table().count() == 21
    batch = spark.createDataFrame([("s3",), ("t",), ("new",)], "seller_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = surrogates.match_registry(batch, again.table(), "seller_id")
        assert rows(matched, "seller_id", "seller_id_int") == [("new", "None"), ("s3", "3"), ("t", "20")]
        plan = matched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan.index("Bucketed: true")
    above = plan[:scan].splitlines()[:-1]
    depth = len(plan[:scan].splitlines()[-1]) - len(plan[:scan].splitlines()[-1].lstrip(" :+-*"))
    for line in reversed(above):  # the operators that the scan feeds
        own = len(line) - len(line.lstrip(" :+-*"))
        if own < depth:
            depth = own
            assert "Exchange" not in line
            if "Join" in line:
                break


def test_registry_takes_older_deltas_and_widens(spark, tmp_path):
    numbers(spark, ("a", 1), ("b", 2)).write.parquet(f"{tmp_path}/seller_id/map_r1.parquet")
    numbers(spark, ("b", 2), ("c", 3)).write.parquet(f"{tmp_path}/seller_id/map_r2.parquet")
    registry = Registry(spark, str(tmp_path), "seller_id", buckets=2)
    assert rows(registry.table(), "seller_id", "seller_id_int") == [("a", "1"), ("b", "2"), ("c", "3")]
    registry.widen(5)
    registry.append(numbers(spark, ("d", 4)))
    assert registry.buckets == 5 and rows(Registry(spark, str(tmp_path), "seller_id").table(), "seller_id") == [("a",), ("b",), ("c",), ("d",)]


# --- ledgers of files ---------------------------------------------------------------------


def test_only_deltas_with_new_files_are_opened(spark, tmp_path):
    base, ledger = f"{tmp_path}/raw", FileLedger(spark, f"{tmp_path}/files")
    letters(spark, "a", "b").write.option("header", True).csv(f"{base}/t_2026_01_01.csv")
    letters(spark, "b", "c").write.parquet(f"{base}/t_2026_01_02.parquet")
    letters(spark, "z").write.parquet(f"{base}/other_2026_01_02.parquet")
    names, files = deltas.unread_deltas(spark, base, "t", ledger)
    assert names == ["t_2026_01_01.csv", "t_2026_01_02.parquet"]
    found = surrogates.discover_keys(deltas.key_scan(spark, base, "t", "id", names), "id")
    assert rows(found, "id") == [("a",), ("b",), ("c",)]
    ledger.record(files)
    assert deltas.unread_deltas(spark, base, "t", ledger)[0] == []
    letters(spark, "d").write.mode("append").parquet(f"{base}/t_2026_01_02.parquet")
    letters(spark, "e").write.parquet(f"{base}/t_2026_01_03.parquet")
    names, files = deltas.unread_deltas(spark, base, "t", ledger)
    assert names == ["t_2026_01_02.parquet", "t_2026_01_03.parquet"] and files.count() >= 2
    assert deltas.unread_deltas(spark, base, "nothing", ledger)[0] == []


def test_catalog_table_gives_new_files_once(spark, tmp_path):
    ledger = FileLedger(spark, f"{tmp_path}/files")
    source = spark.createDataFrame([("a", 1), ("b", 2)], LETTERS)
    source.write.partitionBy("n").parquet(f"{tmp_path}/data")
    spark.sql(f"create table ext_grows (id string, n int) using parquet partitioned by (n) location '{tmp_path}/data'")
    spark.sql("msck repair table ext_grows") if spark.conf.get("spark.sql.catalogImplementation") == "hive" else spark.catalog.recoverPartitions("ext_grows")
    try:
        first, files = deltas.catalog_increment(spark, "ext_grows", ledger)
        assert rows(first, "id", "n") == [("a", "1"), ("b", "2")]
        ledger.record(files)
        nothing, files = deltas.catalog_increment(spark, "ext_grows", ledger)
        assert nothing.count() == files.count() == 0 and nothing.columns == ["id", "n"]
        spark.createDataFrame([("c", 2)], LETTERS).write.mode("append").partitionBy("n").parquet(f"{tmp_path}/data")
        more, _ = deltas.catalog_increment(spark, "ext_grows", ledger)
        assert rows(more, "id", "n") == [("c", "2")]
    finally:
        spark.sql("drop table ext_grows")


def test_ids_of_deltas_that_no_run_opened_are_registered(spark, tmp_path):
    base = lake(tmp_path)
    older = RAW["df_orders"].replace("o1,", "q1,").replace("o2,", "q2,")
    (tmp_path / "raw" / "df_orders_2026_03_20.csv").write_text(older)
    ws = run_pipeline(spark, base)
    known = {r.order_id for r in Registry(spark, ws.id_mapping, "order_id").table().collect()}
    assert {"q1", "q2", "o1", "o2"} <= known
    run = Run(spark, Workspace(base))
    frames, records = run.earlier_ids("order_id")
    assert frames == [] and records == []


# --- facts kept up to date ----------------------------------------------------------------

EVENT = "order_id_int long, seller_id_int long, order_status string, order_date timestamp_ntz, order_year_week string, order_revenue float, lead_time_days int, delivery_delay_days int, approval_lag_days int"


def events(spark, *specs):
    made = [(i, s, "delivered" if i % 2 else "cancelled", d, w, r, lead, None, i) for i, s, d, w, r, lead in specs]
    return spark.createDataFrame(made, EVENT.replace("timestamp_ntz", "string")).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


def test_kept_fact_equals_the_whole_one(spark, tmp_path):
    one = events(spark, (1, 7, "2026-03-02", "2026-W10", 2.5, 3), (2, 7, "2026-03-03", "2026-W10", None, None), (3, 8, "2026-03-10", "2026-W11", 1.0, 4))
    two = events(spark, (4, 7, "2026-03-04", "2026-W10", 4.0, 6), (5, 9, "2026-03-17", "2026-W12", 1.0, 1))
    kept = partials.KeptFact(spark, str(tmp_path), "seller")

    def same(*frames):
        whole = semantic.frozen(semantic.weekly_fact(frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1]), "seller"), weekly_fact_schema("seller"))
        assert rows(kept.fact(), *whole.columns) == rows(whole, *whole.columns)

    assert kept.fact().count() == 0
    assert kept.refresh(one, "2026-03-25") == ["2026-W10", "2026-W11"]
    same(one)
    files = {p.name for p in (tmp_path / "seller_weekly_fact" / "order_year_week=2026-W11").iterdir()}
    assert kept.refresh(two, "2026-03-26") == ["2026-W10", "2026-W12"]
    same(one, two)
    assert files == {p.name for p in (tmp_path / "seller_weekly_fact" / "order_year_week=2026-W11").iterdir()}
    assert kept.refresh(two, "2026-03-26") == ["2026-W10", "2026-W12"]  # the same delta again
    same(one, two)
    fewer = two.where("order_id_int = 4")
    assert kept.refresh(fewer, "2026-03-26") == ["2026-W10", "2026-W12"]  # a week that the delta has lost
    same(one, fewer)
    assert kept.refresh(one.limit(0), "2026-03-25") == ["2026-W10", "2026-W11"]
    same(fewer)


def test_merging_reads_only_some_weeks(spark, tmp_path):
    kept = partials.KeptFact(spark, str(tmp_path), "seller")
    kept.refresh(events(spark, (1, 7, "2026-03-02", "2026-W10", 2.5, 3)), "2026-03-25")
    assert "PushedFilters: [EqualTo(order_year_week,2026-W10)]" in kept.merged({"2026-W10"})._jdf.queryExecution().toString().replace("IsNotNull(order_year_week), ", "")


# --- pointers -----------------------------------------------------------------------------


def test_pointers_are_a_log_and_the_highest_counts(spark, tmp_path):
    first, second = Workspace(str(tmp_path), "20260325T101112_aaaaaa"), Workspace(str(tmp_path), "20260326T101112_bbbbbb")
    assert publishing.current_pointer(spark, first) is None
    assert publishing.activate_version(spark, first)["status"] == "success"
    before = storage.read_text(spark, f"{first.pointers}/0000000001.json")
    assert publishing.activate_version(spark, second)["status"] == "success"
    assert storage.read_text(spark, f"{first.pointers}/0000000001.json") == before
    assert publishing.current_pointer(spark, first)["run_id"] == second.run_id
    assert json.loads(storage.read_text(spark, second.latest_pointer))["number"] == 2
    storage.write_text(spark, f"{first.pointers}/0000000003.json", '{"run_id": ')  # its writer died
    assert publishing.current_pointer(spark, first)["run_id"] == second.run_id


def test_of_two_runs_that_race_one_wins(spark, tmp_path, monkeypatch):
    runs = [Workspace(str(tmp_path), f"20260325T101112_{c * 6}") for c in "abcd"]
    monkeypatch.setattr(publishing, "pointer_names", lambda spark, ws: [])  # all see an empty log
    with ThreadPoolExecutor(4) as pool:
        reports = list(pool.map(lambda ws: publishing.activate_version(spark, ws), runs))
    monkeypatch.undo()
    assert sorted(r["status"] for r in reports) == ["failed"] * 3 + ["success"]
    assert all("another run published" in r["errors"][0] for r in reports if r["status"] == "failed")
    winner = next(ws for ws, r in zip(runs, reports) if r["status"] == "success")
    assert publishing.current_pointer(spark, winner)["run_id"] == winner.run_id


# --- layouts of timestamps ----------------------------------------------------------------


@pytest.mark.parametrize(
    "values, layout, first",
    [
        (["2026-01-02T03:04:05.25", "2026-01-02 03:04:05", "2026-01-02", "x", "1/2/2026", None], "year-month-day", "2026-01-02 03:04:05.250000"),
        (["2026/1/2", "2026/13/2", "2026/01/03 10:00:00"], "year/month/day", "2026-01-02 00:00:00"),
        (["31-12-2025 10:00:00", "01-02-2026T10:00:00"], "day-month-year", "2025-12-31 10:00:00"),
        (["31/12/2025", "2026-01-01", "30/11/2025"], "day/month/year", "2025-12-31 00:00:00"),
        ([None], "year-month-day", "None"),
    ],
)
def test_layout_is_found_and_the_rest_counted(spark, values, layout, first):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    found = temporal.infer_layout(df, ["t"])["t"]
    parsed = [str(r[0]) for r in df.orderBy("i").selectExpr(temporal.parsed(df, "t", found)).collect()]
    known = [v for v in values if v is not None]
    assert found.layout == layout and parsed[0] == first
    assert (found.matched, found.unmatched) == (len(parsed) - parsed.count("None"), len(known) - len(parsed) + parsed.count("None"))


def test_run_reads_creation_dates_of_any_layout(spark, tmp_path):
    header, *lines = RAW["df_customers"].splitlines()
    at = header.split(",").index("account_creation_date")
    changed = [",".join("2024-05-06T07:08:09.5" if i == at else x for i, x in enumerate(line.split(","))) for line in lines]
    ws = run_pipeline(spark, lake(tmp_path, df_customers="\n".join([header, *changed]) + "\n"))
    dim = spark.table(f"customer_semantic.customer_dim_v{ws.run_id}")
    assert {str(r.account_creation_date) for r in dim.collect()} == {"2024-05-06 07:08:09.500000"}
    report = json.loads(storage.read_text(spark, f"{ws.logs}/timestamp_formats_df_customers.json"))["report"]
    assert report["account_creation_date"] == {"layout": "year-month-day", "matched": len(lines), "unmatched": 0}


def test_history_in_the_catalog_is_assembled(spark, tmp_path):
    base = lake(tmp_path)
    first = run_pipeline(spark, base)
    path = f"{first.contracted}/df_orders/delta_date=2026-03-25"
    spark.sql(f"create table contracted_orders using parquet location '{path}'")
    try:
        with pytest.raises(StageFailure):
            Run(spark, first).write(spark.range(1), f"{first.version}")  # never over what is there
        second = run_pipeline(spark, base, catalog={"df_orders": "contracted_orders"})
        fact = spark.read.parquet(f"{second.version}/seller_semantic/seller_weekly_fact_*.parquet").first()
        assert fact.weekly_order_count == 2
    finally:
        spark.sql("drop table contracted_orders")
