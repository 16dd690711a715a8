"""Filter conditions. Each returns a Column; null rules follow SQL unless stated."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from placaflow import config as C


def set_is_active(status_id: Column) -> Column:
    return status_id == C.ACTIVE_SET_STATUS_ID


def benefit_is_active(description: Column) -> Column:
    return description == C.ACTIVE


def benefit_status_in(
    description: Column, statuses: Iterable[str] = C.PARTIAL_BENEFIT_STATUSES
) -> Column:
    return description.isin(*statuses)


def benefit_status_not(description: Column, status: str = C.ACTIVE) -> Column:
    return description != status


def set_status_not_in(description: Column, statuses: Iterable[str] = C.OPEN_SET_STATUSES) -> Column:
    return ~description.isin(*statuses)


def set_status_equals(
    description: Column, statuses: Iterable[str] = C.CANCELLED_SET_STATUSES
) -> Column:
    return description.isin(*statuses)


def identity_not_null(placa: Column, chassi: Column) -> Column:
    return placa.isNotNull() & chassi.isNotNull()


def cancel_date_not_null(date: Column) -> Column:
    return date.isNotNull()


def date_floor(date: Column, floor: dt.date = C.DATE_FLOOR) -> Column:
    return date >= F.lit(floor)


def tick_floor(ticks: Column, floor: dt.date = C.DATE_FLOOR) -> Column:
    """Tick date >= floor, written on the raw number so that the scan can use it.

    Whole days are cut towards zero, hence the two cases around 1900-01-01.
    """
    days = (floor - dt.date(1900, 1, 1)).days
    if days > 0:
        return ticks >= C.TICKS_AT_1900 + days * C.TICKS_PER_DAY
    return ticks > C.TICKS_AT_1900 + (days - 1) * C.TICKS_PER_DAY


def exact_date(date: Column, day: dt.date) -> Column:
    """The day of a timestamp, as a range so that the scan can use it."""
    return (date >= F.lit(day).cast("timestamp_ntz")) & (
        date < F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")
    )


def like_contains(text: Column, part: str) -> Column:
    return text.contains(part)


def id_in_per_brand(
    empresa: Column, identifier: Column, ids: dict[str, Iterable[int]] = C.BENEFIT_IDS
) -> Column:
    condition = F.lit(False)
    for brand, wanted in ids.items():
        condition = condition | ((empresa == brand) & identifier.isin(*wanted))
    return condition


def unit_allow_list(unit: Column, units: Iterable[str] = C.ALLOWED_UNITS) -> Column:
    return unit.isin(*units)


def period_mask(date: Column, start: dt.date, end: dt.date) -> Column:
    return date.between(F.lit(start), F.lit(end))


def days_mask(date: Column, days: Iterable[dt.date]) -> Column:
    return date.isin(*[F.lit(day) for day in days])


def as_of_mask(date: Column, day: dt.date) -> Column:
    return date <= F.lit(day)


def exclude_association(
    empresa: Column,
    member: Column,
    name: str = C.EXCLUDED_ASSOCIATION,
    brands: Iterable[str] = C.EXCLUDED_ASSOCIATION_BRANDS,
) -> Column:
    """In the listed brands a missing member name is dropped too (null condition)."""
    return ~(empresa.isin(*brands) & (member == name))


def exclude_test_members(member: Column, mark: str = C.TEST_MEMBER_MARK) -> Column:
    """Case-sensitive; a missing name is kept."""
    return ~F.coalesce(member.contains(mark), F.lit(False))


def open_invoice_only(historico: Column) -> Column:
    return historico == C.OPEN_INVOICE


def paid_invoice(historico: Column) -> Column:
    return historico != C.OPEN_INVOICE


def is_partial(kind: Column) -> Column:
    return kind == C.PARTIAL


def is_full_with_status(kind: Column, status: Column, wanted: str) -> Column:
    return (kind == C.FULL) & (status == wanted)
