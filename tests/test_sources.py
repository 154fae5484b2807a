"""Deltas, sinks, ingest, control files."""

from __future__ import annotations

import pytest

from orderflume.sources import deltas, sinks, storage
from orderflume.sources.ingest import ingest_batch


def write(spark, path, *values, column="a"):
    df = spark.createDataFrame([(v,) for v in values], f"{column} string")
    if path.endswith(".csv"):
        df.write.option("header", True).csv(path)
    else:
        df.write.parquet(path)


def test_latest_delta_by_name_parquet_after_csv(spark, tmp_path):
    base = str(tmp_path)
    write(spark, f"{base}/df_orders_2026_01_01.parquet", "old")
    write(spark, f"{base}/df_orders_2026_01_02.csv", "text")
    write(spark, f"{base}/df_orders_2026_01_02.parquet", "new")
    write(spark, f"{base}/df_order_items_2026_01_09.parquet", "other table")
    df, stem = deltas.latest_delta(spark, base, "df_orders")
    assert stem == "df_orders_2026_01_02" and df.first().a == "new"
    with pytest.raises(FileNotFoundError):
        deltas.latest_delta(spark, base, "df_payments")


def test_single_files_are_deltas_too(spark, tmp_path):
    (tmp_path / "df_orders_2026_01_01.csv").write_text('a,b\n"x, y",\n"say ""hi""",2\n')
    df, stem = deltas.latest_delta(spark, str(tmp_path), "df_orders")
    assert dict(df.dtypes) == {"a": "string", "b": "string"} and stem == "df_orders_2026_01_01"
    assert [tuple(r) for r in df.collect()] == [("x, y", None), ('say "hi"', "2")]


def test_history_unites_widens_and_keeps_repeats(spark, tmp_path):
    base = str(tmp_path)
    spark.sql("select 1 as k, 'x' as v").write.parquet(f"{base}/t_2026_01_01.parquet")
    spark.sql("select 1L as k, 'x' as v").write.parquet(f"{base}/t_2026_01_02.parquet")
    for df in (deltas.historical_scan(spark, base, "t"), deltas.historical_scan(spark, base, "t", deltas.T.StructType.fromDDL("k bigint, v string"))):
        assert dict(df.dtypes)["k"] == "bigint" and df.count() == 2
    with pytest.raises(FileNotFoundError):
        deltas.historical_scan(spark, base, "missing")
    with pytest.raises(FileNotFoundError):
        deltas.dated_scan(spark, base, "missing")


def test_zoned_timestamps_become_naive(spark):
    from orderflume.functions.rows import naive_timestamps

    df = naive_timestamps(spark.sql("select timestamp '2026-01-01 10:00:00' as t, 1 as n"))
    assert dict(df.dtypes) == {"t": "timestamp_ntz", "n": "int"} and df.first().t.hour == 10


def test_keys_are_scanned_from_both_formats(spark, tmp_path):
    base = str(tmp_path)
    write(spark, f"{base}/df_orders_2026_01_01.parquet", "o1", "o2", column="order_id")
    write(spark, f"{base}/df_orders_2026_01_02.csv", "o2", "o3", column="order_id")
    frames = deltas.key_scan(spark, base, "df_orders", "order_id")
    assert sorted(r.order_id for f in frames for r in f.collect()) == ["o1", "o2", "o2", "o3"]


def test_catalog_table(spark, tmp_path):
    write(spark, f"{tmp_path}/data", "x")
    spark.sql(f"create table ext_full using parquet location '{tmp_path}/data'")
    assert deltas.catalog_scan(spark, "ext_full").count() == 1
    (tmp_path / "none").mkdir()
    spark.sql(f"create table ext_empty (a string) using parquet location '{tmp_path}/none'")
    with pytest.raises(ValueError):
        deltas.catalog_scan(spark, "ext_empty")
    spark.sql("drop table ext_full")
    spark.sql("drop table ext_empty")


def test_export_reports_failure(spark, tmp_path):
    df = spark.range(3)
    assert sinks.export(df, f"{tmp_path}/out")
    assert not sinks.export(df, f"{tmp_path}/out", mode="errorifexists")
    assert sinks.dated_name("t", "20260325T101112_abc123") == "t_2026_03_25"


def test_pointer_is_replaced_in_one_step(spark, tmp_path):
    path = f"{tmp_path}/_latest.json"
    for text in ("one", "two"):
        storage.replace_text(spark, path, text)
        assert storage.read_text(spark, path) == text
    assert not storage.exists(spark, f"{path}.tmp")


def delivery(tmp_path, handshake="file-upload=safe"):
    folder = tmp_path / "in" / "delivery_2026_03_25"
    folder.mkdir(parents=True)
    (folder / "df_orders_2026_03_25.csv").write_text("order_id\no1\no2\n")
    if handshake:
        (folder / "instruction.txt").write_text(handshake)
    return str(folder), str(tmp_path / "lake")


def test_delivery_is_taken_over_once(spark, tmp_path):
    folder, base = delivery(tmp_path)
    first = ingest_batch(spark, folder, base)
    assert first["status"] == "success" and first["files_processed"] == ["df_orders_2026_03_25.csv"]
    assert spark.read.parquet(f"{base}/raw/df_orders_2026_03_25.parquet").count() == 2
    assert spark.read.parquet(f"{base}/archive/delivery_2026_03_25/df_orders_2026_03_25.parquet").count() == 2
    assert storage.exists(spark, f"{base}/status/delivery_2026_03_25.success")
    assert ingest_batch(spark, folder, base)["status"] == "skipped"


@pytest.mark.parametrize("handshake", [None, "file-upload=running"])
def test_delivery_without_handshake_is_left_alone(spark, tmp_path, handshake):
    folder, base = delivery(tmp_path, handshake)
    assert ingest_batch(spark, folder, base)["status"] == "failed"
    assert not storage.exists(spark, f"{base}/status/delivery_2026_03_25.success")


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert storage.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stream_takes_each_file_over_once(spark, tmp_path):
    from orderflume.streaming.deliveries import stream_deliveries

    landing, base = tmp_path / "landing", f"{tmp_path}/lake"
    landing.mkdir()

    def run():
        stream_deliveries(spark, str(landing), "df_payments", base).awaitTermination()
        return sorted(
            tuple(r)
            for r in deltas.historical_scan(spark, f"{base}/raw", "df_payments").collect()
        )

    (landing / "df_payments_2026_03_25.csv").write_text("order_id,payment_value\no1,1.5\no1,1.5\n")
    (landing / "df_orders_2026_03_25.csv").write_text("order_id\nx\n")
    assert run() == [("o1", "1.5"), ("o1", "1.5")]
    (landing / "df_payments_2026_03_26.csv").write_text("order_id,payment_value\no2,\n")
    assert run() == run() == [("o1", "1.5"), ("o1", "1.5"), ("o2", None)]
    names = deltas.delta_names(spark, f"{base}/raw", "df_payments")
    assert names == ["df_payments_2026_03_25.parquet", "df_payments_2026_03_26.parquet"]


def test_files_of_one_stem_are_one_delta(spark, tmp_path):
    folder, base = delivery(tmp_path)
    spark.createDataFrame([("o3",)], "order_id string").write.parquet(f"{folder}/df_orders_2026_03_25.parquet")
    assert ingest_batch(spark, folder, base)["status"] == "success"
    rows = spark.read.parquet(f"{base}/raw/df_orders_2026_03_25.parquet").collect()
    assert sorted(r.order_id for r in rows) == ["o1", "o2", "o3"]


def test_unknown_file_type_fails_the_delivery(spark, tmp_path):
    folder, base = delivery(tmp_path)
    with open(f"{folder}/readme.docx", "w") as file:
        file.write("x")
    assert ingest_batch(spark, folder, base)["status"] == "failed"


def test_stream_keeps_dashed_names_and_late_parts(spark, tmp_path):
    from orderflume.streaming.deliveries import stream_deliveries

    landing, base = tmp_path / "landing", f"{tmp_path}/lake"
    delta = landing / "df_payments_2026-03-25.csv"
    delta.mkdir(parents=True)
    for number, row in enumerate(("o1,1", "o2,2")):
        (delta / f"part-{number}.csv").write_text(f"order_id,payment_value\n{row}\n")
        stream_deliveries(spark, str(landing), "df_payments", base).awaitTermination()
    rows = spark.read.parquet(f"{base}/raw/df_payments_2026-03-25.parquet").collect()
    assert sorted(r.order_id for r in rows) == ["o1", "o2"]


def test_declared_numbers_in_text_count_their_negatives(spark):
    from orderflume.operators import validation

    rows = spark.createDataFrame([("o1", "-5"), ("o2", "many")], "order_id string, payment_value string")
    collapsed = rows.selectExpr("*", "1L as " + validation.COPIES)
    counts = validation.negative_counts(collapsed, text_numbers=True)
    assert collapsed.selectExpr(counts["payment_value"]).first()[0] == 1


def test_layouts_are_grouped_without_a_job_per_delta(spark, tmp_path, monkeypatch):
    base, jobs = f"{tmp_path}/history", []
    for day in range(1, 25):
        kind = "int" if day <= 10 else "bigint"
        spark.range(day, day + 1).selectExpr(f"cast(id as {kind}) as a").coalesce(1).write.parquet(f"{base}/t_2026_01_{day:02d}.parquet")
    paths = [f"{base}/{n}" for n in deltas.delta_names(spark, base, "t")]
    again = deltas.layout_groups
    monkeypatch.setattr(deltas, "layout_groups", lambda s, p: jobs.append(len(p)) or again(s, p))
    groups = deltas.layout_groups(spark, paths)
    assert len(jobs) < len(paths) and sorted(g.schema.simpleString() for g in groups) == ["struct<a:bigint>", "struct<a:int>"]
    assert sorted(r.a for r in deltas.historical_scan(spark, base, "t").collect()) == list(range(1, 25))
