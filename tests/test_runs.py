"""Daily runs: published whole or not at all."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from placaflow.plans import daily
from placaflow.schemas import INVOICES_SCHEMA
from placaflow.sources import sinks

MONDAY, TUESDAY = dt.date(2025, 6, 2), dt.date(2025, 6, 3)


@pytest.fixture
def inputs(fixture, spark):
    fixture.vehicle(5).vehicle(6, chassi="CH2")
    fixture.contract(1, date_inital_effect="2025-05-31").cover(1, 1, id_vehicle=5)
    fixture.contract(2, id_status=2, date_cancellation="2025-05-30").cover(2, 2, id_vehicle=6)
    return fixture.tables(), spark.createDataFrame([(1, 1, 2, 1, "Tag", "a")], INVOICES_SCHEMA)


def seen(spark, out):
    """What readers find: rows of every output of the published run."""
    run = sinks.published_run(spark, out)
    names = ("ativos", "cancelamentos", "cancelamentos_periodo", "relatorio", "base", "arquivo/history", "arquivo/latest")
    return {name: sorted(map(str, spark.read.parquet(f"{run}/{name}").collect())) for name in names}


def test_a_failing_run_leaves_the_one_before(inputs, spark, tmp_path, monkeypatch):
    tables, bills = inputs
    out = str(tmp_path / "out")
    events = daily.stored_events(tables, with_names=True)
    monkeypatch.setattr(daily, "stored_events", lambda *args, **options: events)
    assert sinks.published_run(spark, out) is None
    daily.run_daily(tables, bills, MONDAY, out)
    first = seen(spark, out)
    runs = sinks.published_run(spark, out)
    for sink in ("write_detail", "write_report", "write_history", "write_archive", "publish"):
        with monkeypatch.context() as patch:
            plain = getattr(sinks, sink)

            def broken(*args, plain=plain, sink=sink, **options):
                if sink != "publish":
                    plain(*args, **options)  # written, and then it fails
                raise OSError(sink)

            patch.setattr(sinks, sink, broken)
            with pytest.raises(OSError, match=sink):
                daily.run_daily(tables, bills, TUESDAY, out)
        assert sinks.published_run(spark, out) == runs
    assert seen(spark, out) == first


def test_runs_carry_on_history_and_archive(inputs, spark, tmp_path, monkeypatch):
    tables, bills = inputs
    out = str(tmp_path / "out")
    events = daily.stored_events(tables, with_names=True)
    monkeypatch.setattr(daily, "stored_events", lambda *args, **options: events)
    first = daily.run_daily(tables, bills, MONDAY, out, guard=True)
    second = daily.run_daily(tables, bills, TUESDAY, out, guard=True)
    days = lambda paths: [r.data.day for r in spark.read.parquet(paths["base"]).orderBy("data").collect()]
    assert days(first) == [30, 31, 1] and days(second) == [30, 31, 1, 2]
    archive = spark.read.parquet(f"{second['arquivo']}/history").groupBy("run_date").agg(F.count("*").alias("n"))
    assert sorted((r.run_date.day, r.n) for r in archive.collect()) == [(1, 5), (2, 5)]
    assert sinks.published_run(spark, out) in second["base"]
    # a rerun of a day that is there already leaves the guarded history as it is
    assert days(daily.run_daily(tables, bills, TUESDAY, out, guard=True)) == [30, 31, 1, 2]
    assert sinks.drop_old_runs(spark, out, keep=1) == 2
    assert days({"base": f"{sinks.published_run(spark, out)}/base"}) == [30, 31, 1, 2]
