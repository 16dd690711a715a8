"""The daily job: one pass over the contract chain, then every report from its events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from placaflow import config as C
from placaflow.functions import expressions as X
from placaflow.functions.calendar import reporting_window
from placaflow.plans import detail, kpi
from placaflow.plans.base import Tables
from placaflow.sources import sinks


OUTPUTS = (
    "ativos", "cancelamentos", "cancelamentos_periodo", "relatorio", "base", "arquivo", "planilhas",
)


def stored_events(
    tables: Tables, floor: dt.date = C.DATE_FLOOR, with_names: bool = False, **options
) -> DataFrame:
    """Plate events written once for several reports; without names only what counts need."""
    days = detail.days_of(tables["insurance_reg_set"])
    only = None if with_names else [*days, *detail.COUNT_COLUMNS]
    return detail.plate_events(
        tables, floor=floor, with_names=with_names, only=only, stored="plate-events", **options
    )


def counted_bases(
    tables: Tables, run_date: dt.date, floor: dt.date = C.DATE_FLOOR
) -> tuple[DataFrame, DataFrame]:
    """Active and consolidated base for counting (no names, no order)."""
    events = stored_events(tables, floor)
    return (
        detail.active_plates(events, run_date, ordered=False),
        detail.consolidated_cancellations(events, run_date, floor=floor),
    )


def run_daily(
    tables: Tables,
    invoices: DataFrame,
    run_date: dt.date,
    out: str,
    floor: dt.date = C.DATE_FLOOR,
    mode: str = "weekend_rollup",
    days: int | None = None,
    guard: bool = False,
    sheets: bool = False,
) -> dict[str, str]:
    """Write the detail sets, the report, the history and the archive as one run under `out`.

    The reports are computed from the detail sets just written, so they agree with them.
    History and archive carry on those of the published run. The run is published when all of
    it is written (`sinks.published_run` finds it); its paths are returned.
    `sheets` adds the detail sets as CSV for people: no empty cells, dates as text.
    """
    window = reporting_window(run_date, mode, days)
    run = sinks.new_run(out)
    paths = {name: f"{run}/{name}" for name in OUTPUTS}
    events = stored_events(tables, floor, with_names=True)
    active = detail.active_plates(events, run_date)
    sinks.write_detail(active, paths["ativos"])
    cancelled = detail.consolidated_cancellations(events, run_date, invoices, floor)
    cancelled = cancelled.withColumnRenamed("inadimplente_45", "inadimplente_45+")
    sinks.write_detail(cancelled, paths["cancelamentos"])

    spark = active.sparkSession
    before = sinks.published_run(spark, out)
    active = spark.read.parquet(paths["ativos"])
    cancelled = spark.read.parquet(paths["cancelamentos"])
    of_period = detail.period_cancellations(cancelled, *window)
    sinks.write_detail(of_period, paths["cancelamentos_periodo"])
    if sheets:
        details = {"ativos": active, "cancelamentos": cancelled, "cancelamentos_periodo": of_period}
        for name, df in details.items():
            sinks.write_detail(X.typed_null_fill(df), f"{paths['planilhas']}/{name}", "csv")
    report = kpi.report_summary(active, cancelled, window)
    sinks.write_report(report, paths["relatorio"])
    history = kpi.daily_history(active, cancelled, window)
    sinks.carry_on(spark, before and f"{before}/base", paths["base"], sinks.HISTORY_DAY)
    sinks.carry_on(spark, before and f"{before}/arquivo/history", f"{paths['arquivo']}/history", "run_date")
    sinks.write_history(history, paths["base"], first_day=window[0], guard=guard)
    sinks.write_archive(spark.read.parquet(paths["relatorio"]), paths["arquivo"], window[1])
    sinks.publish(spark, out, run)
    return paths
