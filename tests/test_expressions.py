"""Expressions, predicates and the calendar on single values."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import ticks
from placaflow import config as C
from placaflow.functions import calendar as K
from placaflow.functions import expressions as X
from placaflow.functions import predicates as P

MONDAY = dt.date(2025, 6, 2)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_noon_tick_is_midnight(spark):
    assert ticks("2025-01-01T12:00:00") == 638713296000000000
    moment = one(spark, X.ticks_to_timestamp(F.lit(638713296000000000)))
    assert moment == dt.datetime(2025, 1, 1)


@pytest.mark.parametrize("floor", [dt.date(2025, 1, 1), dt.date(1900, 1, 1), dt.date(1899, 12, 30)])
def test_tick_floor_equals_the_floor_on_the_converted_day(spark, floor):
    start = C.TICKS_AT_1900 + (floor - dt.date(1900, 1, 1)).days * C.TICKS_PER_DAY
    values = [start + d for d in (-2 * C.TICKS_PER_DAY, -C.TICKS_PER_DAY, -1, 0, 1, C.TICKS_PER_DAY)]
    df = spark.createDataFrame([(v,) for v in values], "t long")
    converted = X.ticks_to_timestamp(F.col("t")) >= F.lit(floor).cast("timestamp_ntz")
    rows = df.select(P.tick_floor(F.col("t"), floor).alias("a"), converted.alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_lenient_values(spark):
    df = spark.createDataFrame(
        [("2025-01-02",), ("2025-01-02 10:11:12",), ("x",), (None,)], "v string"
    )
    days = [r.d for r in df.select(X.lenient_date(F.col("v")).alias("d")).collect()]
    assert days == [dt.date(2025, 1, 2), dt.date(2025, 1, 2), None, None]


def test_presentation_fill_leaves_timestamps(spark):
    row = (None, None, None, None)
    df = spark.createDataFrame([row], "n long, s string, d date, t timestamp_ntz")
    assert tuple(X.typed_null_fill(df).first()) == (0, "N/A", "N/A", None)


def test_labels(spark):
    assert one(spark, X.thousands_ptbr(F.lit(1234567))) == "1.234.567"
    friday, sunday = (F.lit(d) for d in K.reporting_window(MONDAY))
    assert one(spark, X.period_label(friday, sunday)) == (
        "30/05/2025 (sexta) - 01/06/2025 (domingo)"
    )
    assert one(spark, X.period_label(sunday, sunday)) == "01/06/2025"
    month = F.lit(dt.date(2025, 5, 3))
    assert one(spark, X.period_label(month, sunday)) == "03/05/2025 - 01/06/2025"
    assert one(spark, X.weekend_marker(F.lit(dt.date(2025, 5, 31)), F.lit(3))) == "SÁBADO"
    assert one(spark, X.weekend_marker(F.lit(MONDAY), F.lit(3))) == "3"
    assert one(spark, X.unit_display_name(F.lit("FTR X"), F.lit("Y"))) == "FTR X"
    assert one(spark, X.unit_display_name(F.lit(None).cast("string"), F.lit("Y"))) == "Y"


def test_reporting_window():
    assert K.reporting_window(MONDAY) == (dt.date(2025, 5, 30), dt.date(2025, 6, 1))
    assert K.reporting_window(MONDAY, "friday_only") == (dt.date(2025, 5, 30),) * 2
    assert K.reporting_window(dt.date(2025, 6, 3)) == (MONDAY, MONDAY)
    assert K.reporting_window(dt.date(2025, 6, 1)) == (dt.date(2025, 5, 31),) * 2
    assert K.reporting_window(MONDAY, "custom", 5) == (dt.date(2025, 5, 28), dt.date(2025, 6, 1))
    with pytest.raises(ValueError):
        K.reporting_window(MONDAY, "custom")
    with pytest.raises(ValueError):
        K.reporting_window(MONDAY, "monthly")


@settings(max_examples=15, deadline=None)
@given(day=st.dates(dt.date(2000, 1, 1), dt.date(2050, 1, 1)), mode=st.sampled_from(K.MODES))
def test_window_columns_follow_the_scalar_rule(spark, day, mode):
    days = 7 if mode == "custom" else None
    start, end = K.reporting_window_columns(F.lit(day), mode, days)
    row = spark.range(1).select(start.alias("a"), end.alias("b")).first()
    assert (row.a, row.b) == K.reporting_window(day, mode, days)


def test_date_spine_includes_both_ends(spark):
    days = [r.landing_date for r in K.date_spine(spark, MONDAY, MONDAY + 2 * K.ONE_DAY).collect()]
    assert days == K.days_between(MONDAY, MONDAY + 2 * K.ONE_DAY)
