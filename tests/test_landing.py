"""Landed days: only wanted ones are opened, all tables of a report count."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest

from placaflow import config as C
from placaflow.plans import backfill
from placaflow.schemas import SOURCE_SCHEMAS
from placaflow.sources import manifest, scan
from placaflow.standin import tables as S

TAG = C.BRANDS[3]
DAYS = [dt.date(2025, 1, 1) + dt.timedelta(days=n) for n in range(400)]
DATA = "/root/testdata/sf0.001"


def land(spark, folder, day, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/landing_date={day}")


@pytest.fixture
def history(spark, tmp_path):
    """400 landed days of one table; all but one hold files that cannot be read."""
    folder = scan.resolve(str(tmp_path), TAG, "benefits")
    for day in DAYS:
        if day != DAYS[350]:
            os.makedirs(f"{folder}/landing_date={day}")
            with open(f"{folder}/landing_date={day}/part-0.parquet", "w") as handle:
                handle.write("no footer")
    land(spark, folder, DAYS[350], [(1, "x"), (2, "y")], "id long, description string")
    return tmp_path, folder


@pytest.mark.parametrize("evolve", [True, False])
def test_one_day_of_a_long_history_opens_its_own_files_only(spark, history, evolve):
    root, _ = history
    rows = scan.scan_snapshot(spark, str(root), TAG, "benefits", DAYS[350], DAYS[350], evolve=evolve)
    assert len(rows.inputFiles()) == 1 and f"landing_date={DAYS[350]}" in rows.inputFiles()[0]
    assert sorted(map(tuple, rows.collect())) == [(DAYS[350], 1, "x"), (DAYS[350], 2, "y")]
    by_day = scan.scan_snapshot_by_day(spark, str(root), TAG, "benefits", [DAYS[350]])
    assert by_day.count() == 2


def test_a_broken_file_of_a_wanted_day_is_an_error(spark, history):
    root, _ = history
    with pytest.raises(Exception, match="footer|Parquet|PARQUET|FAILED_READ"):
        scan.scan_snapshot(spark, str(root), TAG, "benefits", DAYS[349], DAYS[350]).count()


def test_recorded_days_are_not_opened_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "data")
    folder = scan.resolve(root, TAG, "benefits")
    land(spark, folder, DAYS[0], [(1,)], "id long")
    land(spark, folder, DAYS[1], [(2, "x")], "id long, description string")
    land(spark, folder, DAYS[2], [("3", "y")], "id string, description string")
    records = manifest.SchemaRecords(spark, str(tmp_path / "records"))
    opened = []
    plain = scan._opened
    monkeypatch.setattr(scan, "_opened", lambda s, f, days: opened.append(sorted(days)) or plain(s, f, days))

    def read(last):
        rows = scan.scan_snapshot(spark, root, TAG, "benefits", DAYS[0], last, records=records)
        return sorted(map(tuple, rows.collect()), key=str)

    first = [(DAYS[0], 1, None), (DAYS[1], 2, "x")]
    assert read(DAYS[1]) == first
    assert read(DAYS[1]) == first
    assert read(DAYS[2]) == [*first, (DAYS[2], 3, "y")]
    assert opened == [DAYS[:2], [], [DAYS[2]]]
    # a day that has landed anew is opened again
    shutil.rmtree(f"{folder}/landing_date={DAYS[0]}")
    land(spark, folder, DAYS[0], [(7, "new"), (8, "new")], "id long, description string")
    assert read(DAYS[0]) == [(DAYS[0], 7, "new"), (DAYS[0], 8, "new")]
    assert opened[-1] == [DAYS[0]]
    assert read(DAYS[0]) and opened[-1] == []


def test_columns_that_no_day_has_are_an_error(spark, tmp_path):
    folder = scan.resolve(str(tmp_path), TAG, "benefits")
    land(spark, folder, DAYS[0], [(1,)], "id long")
    land(spark, folder, DAYS[1], [("2",)], "id string")
    with pytest.raises(scan.MissingColumns, match="description"):
        scan.scan_snapshot(spark, str(tmp_path), TAG, "benefits", DAYS[0], DAYS[1])
    assert scan.scan_snapshot_by_day(spark, str(tmp_path), TAG, "benefits", DAYS[:2]).count() == 2


def test_manifest_lists_files_without_opening_them(spark, history):
    root, folder = history
    land(spark, scan.resolve(str(root), C.BRANDS[0], "insurance_status"), DAYS[1], [(1, "x")], "id long, description string")
    with open(f"{folder}/landing_date={DAYS[2]}/part-0.parquet", "w"):
        pass  # an empty file is no data
    rows = manifest.landing_manifest(spark, str(root), DAYS[0], DAYS[2], C.BRANDS, ("benefits", "insurance_status"))
    found = {(r.landing_date, r.empresa, r.tabela): (r.files, r.bytes) for r in rows.collect()}
    assert set(found) == {(DAYS[0], "Tag", "benefits"), (DAYS[1], "Tag", "benefits"), (DAYS[1], "Segtruck", "insurance_status")}
    assert found[(DAYS[0], "Tag", "benefits")] == (1, 9) and found[(DAYS[1], "Segtruck", "insurance_status")][1] > 9
    assert manifest.landing_manifest(spark, str(root), DAYS[0], DAYS[2], C.BRANDS, ("none",)).count() == 0


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """Every table of every brand on two days, from the stand-in."""
    root = str(tmp_path_factory.mktemp("landed"))
    days = (S.SNAPSHOT_START, S.SNAPSHOT_START + dt.timedelta(days=1))
    for name, df in S.source_tables(spark, DATA).items():
        for brand in C.BRANDS:
            own = df.where(df.empresa == brand.label).drop("empresa") if "empresa" in df.columns else df
            folder = scan.resolve(root, brand, name)
            own.coalesce(1).write.parquet(f"{folder}/landing_date={days[0]}")
            shutil.copytree(f"{folder}/landing_date={days[0]}", f"{folder}/landing_date={days[1]}")
    return root, days


def flags(spark, root, days, brands=C.BRANDS, reads=backfill.CHAIN_TABLES):
    """(complete, missing tables) of each day, as every backfill adds them to its counts."""
    counts = spark.createDataFrame([], "landing_date date, n long")
    tables = scan.load_snapshots(spark, root, *days, brands)
    rows = backfill.per_snapshot_day(tables, counts, "n", *days, brands, reads)
    return [(r.has_snapshot, r.missing_tables) for r in rows.orderBy("data").collect()]


@pytest.mark.parametrize("name", backfill.CHAIN_TABLES)
def test_a_day_without_any_table_of_the_report_is_not_complete(spark, two_days, tmp_path, name):
    root = str(tmp_path / "copy")
    shutil.copytree(two_days[0], root)
    days = two_days[1]
    shutil.rmtree(f"{scan.resolve(root, TAG, name)}/landing_date={days[1]}")
    assert flags(spark, root, days) == [(True, 0), (False, 1)]
    assert flags(spark, root, days, C.BRANDS[:3]) == [(True, 0), (True, 0)]  # other brands are complete


def test_a_report_without_statuses_is_zero_and_marked(spark, two_days, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(two_days[0], root)
    days = two_days[1]
    for brand in C.BRANDS:
        shutil.rmtree(f"{scan.resolve(root, brand, 'insurance_status')}/landing_date={days[1]}")
    rows = backfill.backfill_active(scan.load_snapshots(spark, root, *days), *days).orderBy("data").collect()
    assert [(r.ativos > 0, r.has_snapshot, r.missing_tables) for r in rows] == [(True, True, 0), (False, False, 4)]


def test_only_tables_of_the_report_count(spark, two_days, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(two_days[0], root)
    days = two_days[1]
    for brand in C.BRANDS[:2]:
        shutil.rmtree(f"{scan.resolve(root, brand, 'representante')}/landing_date={days[0]}")
    assert flags(spark, root, days) == [(True, 0), (True, 0)]
    by_unit = (*backfill.CHAIN_TABLES, *backfill.UNIT_TABLES)
    assert flags(spark, root, days, reads=by_unit) == [(False, 2), (True, 0)]


def test_the_flag_scans_no_table(spark, two_days):
    root, days = two_days
    tables = scan.load_snapshots(spark, root, *days)
    found, wanted = backfill.found_tables(tables)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" not in plan and "FileScan binaryFile [path" in plan and "content" not in plan
    assert wanted == 28 and {r.found for r in found.collect()} == {28}
    assert set(SOURCE_SCHEMAS) >= set(backfill.CHAIN_TABLES) | set(backfill.UNIT_TABLES)
