"""Scans, snapshots and sinks on files."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import ts
from placaflow import config as C
from placaflow.plans import backfill, daily
from placaflow.plans.base import contract_chain
from placaflow.schemas import INVOICES_SCHEMA, SOURCE_SCHEMAS
from placaflow.session import materialise, work_folder
from placaflow.sources import scan, sinks

SEG, TAG = C.BRANDS[0], C.BRANDS[3]
DAYS = [dt.date(2025, 6, d) for d in (1, 2, 3)]


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(path))


def test_text_ids_become_numbers(spark, tmp_path):
    path = scan.resolve(str(tmp_path), SEG, "insurance_status")
    write(spark, path, [("12", "a"), ("x", "b"), (None, "c")], "ID string, DESCRIPTION string")
    rows = scan.load_tables(spark, str(tmp_path), [SEG])["insurance_status"].collect()
    assert sorted((r.id, r.description, r.empresa) for r in rows if r.id) == [(12, "a", "Segtruck")]
    assert sum(r.id is None for r in rows) == 2


def test_absent_snapshots_are_empty_with_their_schema(spark, tmp_path):
    tables = scan.load_snapshots(spark, str(tmp_path), DAYS[0], DAYS[2])
    for name in ("insurance_reg_set", "benefits"):
        assert tables[name].columns == ["landing_date", *SOURCE_SCHEMAS[name].fieldNames(), "empresa"]
        assert tables[name].count() == 0


def test_absent_current_tables_and_invoices_are_errors(spark, tmp_path):
    with pytest.raises(AnalysisException):
        scan.load_tables(spark, str(tmp_path / "none"))["insurance_reg_set"].count()
    with pytest.raises(AnalysisException):
        scan.load_invoices(spark, str(tmp_path / "none"))


def test_an_absent_column_is_an_error(spark, tmp_path):
    path = scan.resolve(str(tmp_path), SEG, "insurance_status")
    write(spark, path, [(12,)], "id long")
    with pytest.raises(scan.MissingColumns, match="description"):
        scan.scan_brand_table(spark, str(tmp_path), SEG, "insurance_status")
    schema = SOURCE_SCHEMAS["insurance_status"]
    (row,) = scan.normalise(spark.read.parquet(path), schema, optional=["description"]).collect()
    assert tuple(row) == (12, None)


def test_a_column_absent_on_the_first_day_keeps_its_values(spark, tmp_path):
    path = scan.resolve(str(tmp_path), TAG, "benefits")
    write(spark, f"{path}/landing_date={DAYS[0]}", [(1,)], "id long")
    write(spark, f"{path}/landing_date={DAYS[1]}", [(2, "x")], "id long, description string")
    df = scan.scan_snapshot(spark, str(tmp_path), TAG, "benefits", DAYS[0], DAYS[2])
    assert sorted(map(tuple, df.collect())) == [(DAYS[0], 1, None), (DAYS[1], 2, "x")]


def test_other_read_errors_surface(spark, tmp_path):
    path = tmp_path / SEG.folder / "insurance_status"
    path.mkdir(parents=True)
    (path / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        scan.load_tables(spark, str(tmp_path))["insurance_status"].count()
    assert "PATH_NOT_FOUND" not in str(error.value)


def test_snapshot_days_are_pruned(spark, tmp_path):
    path = scan.resolve(str(tmp_path), TAG, "benefits")
    for day in DAYS:
        write(spark, f"{path}/landing_date={day}", [(day.day, "x")], "id long, description string")
    df = scan.scan_snapshot(spark, str(tmp_path), TAG, "benefits", DAYS[1], DAYS[1])
    assert [tuple(r) for r in df.collect()] == [(DAYS[1], 2, "x")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landing_date" in plan


def test_filters_reach_the_scan_when_types_agree(spark, tmp_path):
    path = scan.resolve(str(tmp_path), TAG, "benefits")
    write(spark, path, [(1, "x")], "id long, description string")
    df = scan.scan_brand_table(spark, str(tmp_path), TAG, "benefits").where("id = 7").select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,7)" in plan and "ReadSchema: struct<id:bigint>" in plan


def test_history_is_idempotent_and_guarded(spark, tmp_path):
    path = str(tmp_path / "base")

    def rows(day, n):
        return spark.createDataFrame([(day, n, 0, 0)], "data date, qtd_ativos long, ativados long, cancelados long")

    assert sinks.next_history_day(spark, path) is None
    assert sinks.write_history(rows(DAYS[0], 1), path, DAYS[0], guard=True)
    assert sinks.write_history(rows(DAYS[1], 2), path, DAYS[1], guard=True)
    assert not sinks.write_history(rows(DAYS[1], 9), path, DAYS[1], guard=True)
    assert sinks.write_history(rows(DAYS[1], 5), path, DAYS[1])
    stored = {r.data: r.qtd_ativos for r in spark.read.parquet(path).collect()}
    assert stored == {DAYS[0]: 1, DAYS[1]: 5}


def test_sql_file_with_arguments(spark, tmp_path):
    write(spark, tmp_path / "t", [(1,), (2,)], "id long")
    names = scan.register_views({"t": spark.read.parquet(str(tmp_path / "t"))}, prefix="my_")
    sql = tmp_path / "q.sql"
    sql.write_text("SELECT id FROM my_t WHERE id > :low")
    assert names == ["my_t"]
    assert [r.id for r in scan.run_sql_file(spark, sql, low=1).collect()] == [2]
    with pytest.raises(AnalysisException):
        scan.run_sql_file(spark, sql)


def test_daily_job(fixture, spark, tmp_path):
    fixture.vehicle(5).vehicle(6, chassi="CH2").vehicle(7, chassi="CH3")
    fixture.contract(1, date_inital_effect="2025-05-31").cover(1, 1, id_vehicle=5)
    fixture.contract(2, id_status=2, date_cancellation="2025-05-30").cover(2, 2, id_vehicle=6)
    fixture.contract(3, id_status=3, date_cancellation="2025-06-01").cover(3, 3, id_vehicle=7)
    bills = spark.createDataFrame([(1, 1, 2, 1, "Tag", "a")], INVOICES_SCHEMA)
    out = str(tmp_path / "out")
    for _ in range(2):  # a rerun of the day leaves the same result
        paths = daily.run_daily(fixture.tables(), bills, dt.date(2025, 6, 2), out, sheets=True)
    report = spark.read.parquet(paths["relatorio"]).orderBy("ordem").collect()
    assert [r.empresa for r in report] == ["SEGTRUCK", "STCOOP", "VIAVANTE", "TAG", "Total"]
    assert tuple(report[0])[2:6] == tuple(report[4])[2:6] == (1, 1, 1, 0)
    history = spark.read.parquet(paths["base"]).orderBy("data").collect()
    assert [(r.qtd_ativos, r.ativados, r.cancelados) for r in history] == [
        (0, 0, 1), (1, 1, 0), (1, 0, 1),
    ]
    cancelled = spark.read.parquet(paths["cancelamentos"])
    assert {(r.chassi, r["inadimplente_45+"]) for r in cancelled.collect()} == {
        ("CH2", "SIM"), ("CH3", "NÃO"),
    }
    of_period = spark.read.parquet(paths["cancelamentos_periodo"])
    assert of_period.where(F.col("data_cancelamento") == "2025-05-30").count() == 1
    assert spark.read.parquet(f"{paths['arquivo']}/latest").count() == 5
    sheet = spark.read.option("header", True).csv(f"{paths['planilhas']}/cancelamentos")
    assert {(r.unidade, r.id_carroceria) for r in sheet.collect()} == {("N/A", "0")}
    assert ts("2025-05-30").date() == history[0].data


def test_types_that_change_between_days(spark, tmp_path):
    path = scan.resolve(str(tmp_path), TAG, "benefits")
    write(spark, f"{path}/landing_date={DAYS[0]}", [("1", "x")], "id string, description string")
    write(spark, f"{path}/landing_date={DAYS[2]}", [(2, "y")], "id long, description string")
    tables = scan.load_snapshots(spark, str(tmp_path), DAYS[0], DAYS[2], by_day=True)
    rows = tables["benefits"].select("landing_date", "id", "empresa").collect()
    assert sorted(map(tuple, rows)) == [(DAYS[0], 1, "Tag"), (DAYS[2], 2, "Tag")]


def test_scans_depend_on_schemas_not_on_days(spark, tmp_path):
    path = scan.resolve(str(tmp_path), TAG, "benefits")
    days = [dt.date(2025, 6, 1) + dt.timedelta(days=n) for n in range(60)]
    kinds = ["id string, description string", "id long, description string"]
    for n, day in enumerate(days):
        kind = kinds[n >= 25]
        write(spark, f"{path}/landing_date={day}", [(n if "long" in kind else str(n), "x")], kind)
    df = scan.scan_snapshot_by_day(spark, str(tmp_path), TAG, "benefits", days)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert sorted((r.landing_date, r.id) for r in df.collect()) == [(d, n) for n, d in enumerate(days)]


def test_a_day_without_a_brand_is_marked(dated_fixture):
    for day in ("2025-06-01", "2025-06-02"):
        for n, brand in enumerate(C.BRANDS):
            if brand is TAG and day == "2025-06-02":
                continue
            dated_fixture.vehicle(n, brand.label, chassi=f"CH{n}", day=day)
            dated_fixture.contract(n, brand.label, day).cover(n, n, brand.label, day, id_vehicle=n)
    rows = backfill.backfill_active(dated_fixture.tables(), DAYS[0], DAYS[2]).orderBy("data").collect()
    assert [tuple(r)[1:] for r in rows] == [(4, True, 0), (3, False, 3), (0, False, 12)]


def test_registrations_without_a_set_are_kept(fixture):
    fixture.contract(1).cover(5, 1).contract(2).add("insurance_registration", id=77, customer_id=1)
    rows = contract_chain(fixture.tables()).select("matricula", "conjunto", "coverage_id").collect()
    assert sorted(map(tuple, rows)) == [(10, 1, 5), (20, 2, None), (77, None, None)]


def named_session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


def test_work_folder_is_a_shared_one():
    named = {"spark.checkpoint.dir": "s3://shared/work/", "spark.sql.warehouse.dir": "s3://house"}
    assert work_folder(named_session(**named)) == "s3://shared/work"
    assert work_folder(named_session(**{"spark.sql.warehouse.dir": "s3://house"})) == "s3://house/_work"


def test_materialised_frames_keep_their_rows(spark):
    kept = materialise(spark.range(10).selectExpr("id", "id % 2 AS kind"), "t", "kind")
    assert kept.where("kind = 1").count() == 5
    assert kept.columns == ["id", "kind"]
    assert any(work_folder(spark) in file for file in kept.inputFiles())


def test_invoices_are_normalised(spark, tmp_path):
    rows = [("1", 1, "7", "x", "Tag", "a")]
    schema = "ponteiro string, historico int, conjunto string, matricula string, empresa string, associado string"
    write(spark, tmp_path / "bills", rows, schema)
    (row,) = scan.load_invoices(spark, str(tmp_path / "bills")).collect()
    assert (row.ponteiro, row.conjunto, row.matricula) == (1, 7, None)
