"""Plans over large tables run in steps: the same rows, and one step's files on the disk."""

from __future__ import annotations

import glob
import random
import re

import pytest

import __spark_entry__ as entry
from placaflow import config as C
from placaflow import session
from placaflow.plans import adhoc, base, detail
from placaflow.standin import tables as S

DATA = "/root/testdata/sf0.001"


def shuffle_files(spark) -> int:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return len(re.findall(r"shuffle_\d+_\d+_\d+\.data", manager.getAllFiles().toString()))


def step_folders(spark) -> list[str]:
    return glob.glob(f"{session.work_folder(spark).removeprefix('file:')}/step-*")


@pytest.fixture
def in_steps(monkeypatch):
    monkeypatch.setattr(session, "STEPS_FROM", 0)
    monkeypatch.setattr(session, "UNKNOWN_SIZE", 1 << 100)


@pytest.fixture
def shuffle_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def odd_rows(fixture, seed: int):
    """Coverages with repeated and null ids and brands, with and without plates, on few sets."""
    rng = random.Random(seed)
    for n in range(6):
        fixture.contract(n // 2 if n < 4 else n, C.BRANDS[n % 2].label, id_status=rng.choice([7, 2, 3]),
                         date_cancellation=rng.choice([None, "2025-05-01"]))
        fixture.vehicle(n, C.BRANDS[n % 2].label, rng.choice([None, "P1"]), rng.choice([None, "c1", "c2"]))
        fixture.trailer(n, C.BRANDS[n % 2].label, rng.choice([None, "T1"]), rng.choice([None, "c1", "t2"]))
    for _ in range(60):
        brand, some = rng.choice([C.BRANDS[0].label, C.BRANDS[1].label, None]), [None, *range(6)]
        fixture.cover(rng.choice([None, 1, 2, 3, 4]), rng.randrange(6), brand, id_vehicle=rng.choice(some),
                      id_trailer=rng.choice(some), id_status=rng.choice([7, 2, 9]), updated_at=rng.choice([C.TICKS_AT_1900 + d for d in (0, 5)]) + 46_000 * C.TICKS_PER_DAY)
        fixture.add("insurance_reg_set_cov_trailer", brand, parent=rng.choice([None, 1, 2]), id_trailer=rng.choice(some))
    return fixture.tables()


def rows_of(df) -> list[str]:
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows_are_the_same_in_steps(spark, fixture, monkeypatch, seed):
    tables = odd_rows(fixture, seed)

    def found() -> list[list[str]]:
        events = detail.plate_events(tables, with_names=False, only=detail.COUNT_COLUMNS, stored="events")
        chassis = events.select(detail.EVENT, "chassi", "empresa", "coverage_id").distinct()
        return [rows_of(adhoc.master_listing(tables)), rows_of(chassis)]

    whole = found()
    monkeypatch.setattr(session, "STEPS_FROM", 0)
    monkeypatch.setattr(session, "UNKNOWN_SIZE", 1 << 100)
    assert found() == whole and all(whole)


@pytest.mark.parametrize("name", ["master_listing", "consolidated_cancellations", "full_cancellations_any_status", "backfill_cancellations"])
def test_queries_are_the_same_in_steps(spark, monkeypatch, name):
    whole = rows_of(entry.queries()[name](spark, DATA))
    monkeypatch.setattr(session, "STEPS_FROM", 0)
    assert rows_of(entry.queries()[name](spark, DATA)) == whole and whole


def test_steps_go_when_the_next_one_is_written(spark, in_steps):
    before = set(step_folders(spark))
    detail.plate_events(S.source_tables(spark, DATA), stored="events")
    assert set(step_folders(spark)) == before


def test_the_listing_holds_one_step(spark, in_steps):
    before = set(step_folders(spark))
    rows = adhoc.master_listing(S.source_tables(spark, DATA))
    assert len(set(step_folders(spark)) - before) == 1  # the one that is still to be read
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "insurance" not in plan and len(re.findall(r"step-\w+", plan)) == 1


def test_small_tables_stay_whole(spark):
    assert not base.steps_over(S.source_tables(spark, DATA)).on


def test_shuffle_files_go_with_the_write(shuffle_only):
    spark = shuffle_only
    spark._jvm.System.gc()
    setting = spark.conf.get(session._CLEANUP, None)
    before = shuffle_files(spark)
    tables = S.source_tables(spark, DATA)
    kept = session.materialise(base.sets_with_coverages(base.contract_sets(tables), base.coverages(tables)), "kept")
    assert shuffle_files(spark) <= before
    assert kept.count() > 0 and spark.conf.get(session._CLEANUP, None) == setting


def test_the_bridge_shuffles_the_coverages_once(shuffle_only):
    tables = S.source_tables(shuffle_only, DATA)
    rows = base.bridged_trailers(base.coverages(tables), tables)
    assert rows.count() > 0
    rows.collect()
    final = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"- Exchange hashpartitioning\(coverage_id", final)) == 1
    assert re.search(r"ReusedExchange \[.*coverage_id", final)
