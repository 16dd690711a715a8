"""Named queries over the test data, each with its SQL twin where one exists."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from placaflow.functions.calendar import reporting_window
from placaflow.sources.lazy import LazyTables
from placaflow.standin import tables as S
from placaflow.standin.oracle import with_tables

# Report parameters of the test data (its dates end on 2001-08-01).
RUN_DATE = dt.date(2001, 7, 30)
WEEKDAY_RUN = dt.date(2001, 7, 26)
FLOOR = dt.date(1998, 1, 1)
CUSTOM_DAYS = 30


class Source:
    """The stand-in tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def tables(self) -> LazyTables:
        return S.source_tables(self.spark, self.sf_dir)

    @cached_property
    def snapshots(self) -> LazyTables:
        return S.snapshot_tables(self.spark, self.sf_dir)

    @cached_property
    def invoices(self) -> DataFrame:
        return S.invoices(self.spark, self.sf_dir)

    def raw(self, name: str) -> DataFrame:
        return S.read(self.spark, self.sf_dir, name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a `Source` under a name, with its SQL twin."""

    def register(build: Callable[[Source], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Source(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return build

    return register


def window(mode: str = "weekend_rollup") -> tuple[dt.date, dt.date]:
    return reporting_window(RUN_DATE, mode, CUSTOM_DAYS if mode == "custom" else None)
