"""Scalar expressions (all built-in, all inside whole-stage codegen)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placaflow import config as C


def plate_identity(field: str, origins: list[str]) -> Column:
    """First non-null of one field over the plate's origins, each field on its own."""
    return F.coalesce(*[f"{origin}_{field}" for origin in origins])


def effective_start(initial: Column, final: Column, days: int = C.CONTRACT_DAYS_BACK) -> Column:
    """Start date of validity; without one, counted back from the end."""
    return F.coalesce(initial.cast("date"), F.date_sub(final.cast("date"), days))


def ticks_to_timestamp(ticks: Column) -> Column:
    """100-ns ticks since year 1 to the midnight of their day (integer division)."""
    days = F.call_function("div", ticks - F.lit(C.TICKS_AT_1900), F.lit(C.TICKS_PER_DAY))
    start = F.lit(dt.date(1900, 1, 1))
    return F.date_add(start, days.cast("int")).cast("timestamp_ntz")


def upper_all_strings(df: DataFrame) -> DataFrame:
    """Upper-case every string column; nulls stay null."""
    return df.select(
        *[
            F.upper(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def unit_display_name(nome: Column, fantasia: Column) -> Column:
    """Franchise units show their registered name, the others their trade name."""
    return F.when(nome.contains(C.FRANCHISE_NAME_MARK), nome).otherwise(fantasia)


def commercial_category(unit: Column, pattern: str = C.FRANCHISE_PATTERN) -> Column:
    """Sales channel by keyword anywhere in the unit name; no unit means partner."""
    is_franchise = F.coalesce(unit.rlike(f"(?i){pattern}"), F.lit(False))
    return F.when(is_franchise, C.FRANCHISE_CATEGORY).otherwise(C.PARTNER_CATEGORY)


def flag_to_label(condition: Column) -> Column:
    return F.when(condition, C.YES).otherwise(C.NO)


def lenient_date(value: Column) -> Column:
    """Date of a date, timestamp or text; what cannot be read becomes null."""
    return value.try_cast("date")


def typed_null_fill(df: DataFrame) -> DataFrame:
    """Presentation fill: numbers 0, text and dates `N/A` (dates become text)."""

    def filled(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(column, F.lit(0).cast(field.dataType)).alias(field.name)
        if isinstance(field.dataType, (T.StringType, T.DateType)):
            return F.coalesce(column.cast("string"), F.lit(C.MISSING_TEXT)).alias(field.name)
        return column

    return df.select(*[filled(f) for f in df.schema.fields])


def thousands_ptbr(number: Column) -> Column:
    """12345 -> 12.345"""
    return F.translate(F.format_number(number, 0), ",", ".")


def period_label(start: Column, end: Column) -> Column:
    """`dd/mm/yyyy`, `dd/mm/yyyy (sexta) - dd/mm/yyyy (domingo)` for a Friday and the Sunday
    after it, `dd/mm/yyyy - dd/mm/yyyy` for other windows."""
    first, last = (F.date_format(d, "dd/MM/yyyy") for d in (start, end))
    weekend = (F.weekday(start) == 4) & (F.date_add(start, 2) == end)
    return (
        F.when(start == end, last)
        .when(weekend, F.concat(first, F.lit(" (sexta) - "), last, F.lit(" (domingo)")))
        .otherwise(F.concat(first, F.lit(" - "), last))
    )


def label_concat(*columns: Column) -> Column:
    return F.concat_ws(" - ", *columns)


def weekend_marker(date: Column, number: Column) -> Column:
    """Older history rows show the weekend day's name in place of the count."""
    weekday = F.weekday(date)
    return (
        F.when(weekday == 5, F.lit(C.SATURDAY_MARK))
        .when(weekday == 6, F.lit(C.SUNDAY_MARK))
        .otherwise(number.cast("string"))
    )


def brand_rank(empresa: str = "empresa") -> str:
    """SQL for a brand's position in the report, whatever the letter case of its label."""
    cases = " ".join(f"WHEN '{b.label.upper()}' THEN {b.rank}" for b in C.BRANDS)
    return f"CASE upper({empresa}) {cases} END"
