"""Reporting windows. The run date is always an argument, never the clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ONE_DAY = dt.timedelta(days=1)
MODES = ("weekend_rollup", "friday_only", "custom")


def reporting_window(
    run_date: dt.date, mode: str = "weekend_rollup", days: int | None = None
) -> tuple[dt.date, dt.date]:
    """First and last day reported on `run_date`, both inclusive.

    weekend_rollup: Mondays report Friday to Sunday, other days report yesterday.
    friday_only: Mondays report Friday alone. custom: the last `days` days.
    """
    if mode not in MODES:
        raise ValueError(f"unknown reporting mode {mode!r}; expected one of {MODES}")
    yesterday = run_date - ONE_DAY
    if mode == "custom":
        if not days or days < 1:
            raise ValueError("a custom window needs days >= 1")
        return yesterday - (days - 1) * ONE_DAY, yesterday
    if run_date.weekday() != 0:
        return yesterday, yesterday
    friday = run_date - 3 * ONE_DAY
    return (friday, friday) if mode == "friday_only" else (friday, yesterday)


def reporting_window_columns(
    run_date: Column, mode: str = "weekend_rollup", days: int | None = None
) -> tuple[Column, Column]:
    """The same rule for a date column (one window per snapshot day)."""
    if mode not in MODES:
        raise ValueError(f"unknown reporting mode {mode!r}; expected one of {MODES}")
    yesterday = F.date_sub(run_date, 1)
    if mode == "custom":
        if not days or days < 1:
            raise ValueError("a custom window needs days >= 1")
        return F.date_sub(run_date, days), yesterday
    monday = F.weekday(run_date) == 0
    start = F.when(monday, F.date_sub(run_date, 3)).otherwise(yesterday)
    return start, start if mode == "friday_only" else yesterday


def days_between(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + n * ONE_DAY for n in range((end - start).days + 1)]


def days_of(spark: SparkSession, days: Iterable[dt.date], name: str = "landing_date") -> DataFrame:
    """One row for each of some days, which are in order; a plain range takes no list of them."""
    days = list(days)
    if days and days == days_between(days[0], days[-1]):
        return date_spine(spark, days[0], days[-1], name)
    listed = F.array(*[F.lit(day) for day in days]).cast("array<date>")
    return spark.range(0, 1, 1, 1).select(F.explode(listed).alias(name))


def date_spine(
    spark: SparkSession, start: dt.date, end: dt.date, name: str = "landing_date"
) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(0, 1, 1, 1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias(name)
    )
