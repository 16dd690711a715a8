"""Snapshot backfills: all days in one job.

Counts over many days first turn the snapshots into spans (`operators.spans`): a row stands once
for all days on which it is the same, so the contract chain is joined once on what changed, not
once a day, and counts are sums of changes. Where only counts are asked, the choice per chassis
is a distinct or a maximum, which Spark combines before the shuffle. A single day
(`active_on_day`) is read as it is: the scope of its tables includes the snapshot day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placaflow import config as C
from placaflow.functions import calendar as K
from placaflow.functions import expressions as X
from placaflow.functions import predicates as P
from placaflow.operators.dedupe import keep_first
from placaflow.operators.joins import BRAND, DAY, SPAN, scope_of
from placaflow.operators.sets import union_by_name
from placaflow.operators.spans import (
    count_distinct_by_day,
    count_latest_within,
    first_by_day,
    spans_of,
)
from placaflow.plans.base import (
    NAME_COLUMNS,
    PLATE_REFERENCE,
    Tables,
    bridged_trailers,
    contract_sets,
    coverages,
    customer_lookup,
    reduce_plates,
    sets_with_coverages,
    uncovered_sets,
    unit_lookup,
    vehicle_or_trailer,
)
from placaflow.plans.detail import EVENT, LATEST, latest_order, plate_events
from placaflow.schemas import SOURCE_SCHEMAS
from placaflow.session import materialise
from placaflow.sources.lazy import LazyTables
from placaflow.sources.manifest import found_pairs


#: Tables that every backfill reads, and those that choose contracts by unit.
CHAIN_TABLES = (
    "insurance_registration", "insurance_reg_set", "insurance_reg_set_coverage",
    "insurance_reg_set_cov_trailer", "insurance_vehicle", "insurance_trailer", "insurance_status",
)
UNIT_TABLES = ("representante", "catalogo")
#: Tables whose rows show that a day is there, where no manifest says what has landed.
COUNTED_TABLES = ("insurance_registration", "insurance_reg_set", "insurance_reg_set_coverage")


def found_tables(
    tables: Tables, brands: Iterable[C.BrandSpec] = C.BRANDS, reads: Iterable[str] = CHAIN_TABLES
) -> tuple[DataFrame, int]:
    """Per snapshot day, how many of the brands' tables are there; and how many should.

    With a manifest, a table is there if it has files of that day and brand: all tables that
    the report reads count, and no table is scanned. Frames without one are taken by their
    rows in `COUNTED_TABLES`; those without a day are there whenever others are.
    """
    brands = list(brands)
    manifest = getattr(tables, "manifest", None)
    if manifest is not None:
        reads = list(reads)
        return found_pairs(manifest(), brands, reads), len(reads) * len(brands)
    labels = [brand.label for brand in brands]
    dated = [tables[name] for name in COUNTED_TABLES if DAY in tables[name].columns]
    pairs = [df.where(F.col(BRAND).isin(labels)).select(DAY, BRAND).distinct() for df in dated]
    always = (len(COUNTED_TABLES) - len(dated)) * len(labels)
    found = union_by_name(pairs).groupBy(DAY).agg((F.count("*") + always).alias("found"))
    return found, len(COUNTED_TABLES) * len(labels)


def per_snapshot_day(
    tables: Tables,
    counts: DataFrame,
    measure: str,
    start: dt.date,
    end: dt.date,
    brands: Iterable[C.BrandSpec] = C.BRANDS,
    reads: Iterable[str] = CHAIN_TABLES,
) -> DataFrame:
    """One row per calendar day: the count (0 where none), whether the snapshot is complete
    and how many tables of how many brands it lacks."""
    spark = counts.sparkSession
    found, wanted = found_tables(tables, brands, reads)
    spine = K.date_spine(spark, start, end, DAY)
    missing = F.lit(wanted).cast("long") - F.coalesce(F.col("found"), F.lit(0))
    return (
        spine.join(found, DAY, "left")
        .join(counts, DAY, "left")
        .select(
            F.col(DAY).alias("data"),
            F.coalesce(F.col(measure), F.lit(0)).alias(measure),
            (missing == 0).alias("has_snapshot"),
            missing.alias("missing_tables"),
        )
    )


def _between(tables: Tables, start: dt.date, end: dt.date) -> Tables:
    """Dated tables cut to the wanted days (pruned at the scan)."""

    def cut(df: DataFrame) -> DataFrame:
        if DAY not in df.columns:
            return df
        return df.where(F.col(DAY).between(F.lit(start), F.lit(end)))

    manifest = getattr(tables, "manifest", None)
    return LazyTables({name: lambda name=name: cut(tables[name]) for name in tables}, manifest)


def _reads(units: Iterable[str] | None) -> tuple[str, ...]:
    """The tables a count reads: names of units only where units are chosen."""
    return CHAIN_TABLES if units is None else (*CHAIN_TABLES, *UNIT_TABLES)


#: Columns of the tables that change most which the counts read; no other change ends a span.
COUNTED_COLUMNS = {
    "insurance_reg_set": (
        "id", "parent", "id_status", "id_unity", "data_registration", "date_inital_effect",
        "date_final_effect", "date_cancellation",
    ),
    "insurance_reg_set_coverage": ("id", "parent", "id_vehicle", "id_trailer", "id_status"),
}


def landed_days(tables: Tables, start: dt.date, end: dt.date) -> list[dt.date]:
    """Days between the two on which some table landed, in order (collected: one row a day)."""
    manifest = getattr(tables, "manifest", None)
    if manifest is not None:
        found = manifest().select(DAY)
    else:
        dated = [tables[name] for name in COUNTED_TABLES if DAY in tables[name].columns]
        found = union_by_name(df.select(DAY) for df in dated)
    between = found.where(F.col(DAY).between(F.lit(start), F.lit(end))).distinct()
    return sorted(row[DAY] for row in between.collect())


def span_tables(
    tables: Tables, start: dt.date, end: dt.date, more: Iterable[str] = ()
) -> tuple[LazyTables, list[dt.date]]:
    """Snapshots between two days as spans, and the days that landed.

    Each dated table is written once as spans (a single day is read as it is); `more` names columns of coverages that the report
    reads besides `COUNTED_COLUMNS`. Columns that are left out are null.
    """
    days = landed_days(tables, start, end)
    read = dict(COUNTED_COLUMNS)
    read["insurance_reg_set_coverage"] = (*read["insurance_reg_set_coverage"], *more)

    def opened(name: str) -> DataFrame:
        df = tables[name]
        if DAY not in df.columns:
            return df
        fields = [f for f in SOURCE_SCHEMAS[name].fields if f.name in df.columns]
        wanted = [f.name for f in fields if f.name in read.get(name, (f.name,))]
        brand = [c for c in (BRAND,) if c in df.columns]
        spans = spans_of(df.select(DAY, *brand, *wanted), days)
        if len(days) > 1:
            spans = materialise(spans, f"spans-{name}")
        empty = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in wanted}
        return spans.withColumns(empty) if empty else spans

    return LazyTables({name: lambda name=name: opened(name) for name in tables}), days


def _windows(days: list[dt.date], mode: str) -> list[tuple[dt.date, dt.date, dt.date]]:
    return [(day, *K.reporting_window(day, mode)) for day in days]


def backfill_active(
    tables: Tables,
    start: dt.date,
    end: dt.date,
    brands: Iterable[C.BrandSpec] = C.BRANDS,
) -> DataFrame:
    """Active chassis per snapshot day."""
    spans, days = span_tables(tables, start, end)
    rows = _plates(_active_references(spans), spans, ["board", "chassi"])
    rows = rows.where(P.identity_not_null(F.col("placa"), F.col("chassi")))
    counts = count_distinct_by_day(rows, "chassi", days, "ativos")
    return per_snapshot_day(tables, counts, "ativos", start, end, brands)


def _active_references(tables: Tables, sets: DataFrame | None = None) -> DataFrame:
    """Plate references of active benefits per day and brand, with their latest start."""
    if sets is None:
        sets = contract_sets(tables, P.set_is_active(F.col("status_id")))
    rows = coverages(tables, P.benefit_is_active(F.col("status_beneficio")))
    rows = bridged_trailers(sets_with_coverages(sets, rows), tables)
    return _latest_per_reference(rows, "inicio_vig")


def _latest_per_reference(rows: DataFrame, date: str) -> DataFrame:
    """Latest date per plate reference, brand and day."""
    return rows.groupBy(*PLATE_REFERENCE, *scope_of(rows)).agg(F.max(date).alias(date))


def _plates(rows: DataFrame, tables: Tables, fields: Iterable[str]) -> DataFrame:
    """Plates of rows that are told apart by their references, brand and day."""
    return vehicle_or_trailer(rows, tables, fields, by=[*PLATE_REFERENCE, *scope_of(rows)])


def _units(
    sets: DataFrame, tables: Tables, units: Iterable[str]
) -> DataFrame:
    """Sets of the listed units: filtered before the coverages are joined."""
    sets = unit_lookup(sets, tables, by=["conjunto"])
    return sets.where(P.unit_allow_list(F.col("unidade"), units)).drop("unidade")


def backfill_activated(
    tables: Tables,
    start: dt.date,
    end: dt.date,
    units: Iterable[str] | None = None,
    mode: str = "weekend_rollup",
    brands: Iterable[C.BrandSpec] = C.BRANDS,
) -> DataFrame:
    """Activations in each snapshot's reporting window; plate and chassis may be missing.

    With `units`, only their contracts count, and they are selected before the choice
    per chassis.
    """
    spans, days = span_tables(tables, start, end)
    sets = contract_sets(spans, P.set_is_active(F.col("status_id")))
    if units is not None:
        sets = _units(sets, spans, units)
    rows = _plates(_active_references(spans, sets), spans, ["chassi"])
    counts = count_latest_within(rows, "chassi", "inicio_vig", _windows(days, mode), "total_ativados")
    return per_snapshot_day(tables, counts, "total_ativados", start, end, brands, _reads(units))


def backfill_cancelled(
    tables: Tables,
    start: dt.date,
    end: dt.date,
    units: Iterable[str] | None = None,
    statuses: Iterable[str] = C.CANCELLED_SET_STATUSES,
    mode: str = "weekend_rollup",
    brands: Iterable[C.BrandSpec] = C.BRANDS,
) -> DataFrame:
    """Cancelled sets dated by their final day, in each snapshot's reporting window.

    Sets without a coverage share the null chassis.
    """
    spans, days = span_tables(tables, start, end)
    sets = contract_sets(spans, P.set_status_equals(F.col("status"), statuses))
    if units is not None:
        sets = _units(sets, spans, units)
    rows = bridged_trailers(sets_with_coverages(sets, coverages(spans)), spans)
    rows = _plates(_latest_per_reference(rows, "fim_vig"), spans, ["chassi"])
    bare = uncovered_sets(sets, spans).withColumn("chassi", F.lit(None).cast("string"))
    columns = ["chassi", *[c for c in SPAN if c in rows.columns], "fim_vig"]
    rows = rows.select(*columns).unionByName(bare.select(*columns))
    counts = count_latest_within(rows, "chassi", "fim_vig", _windows(days, mode), "total_cancelados")
    return per_snapshot_day(tables, counts, "total_cancelados", start, end, brands, _reads(units))


def backfill_cancellations(
    tables: Tables,
    start: dt.date,
    end: dt.date,
    floor: dt.date = C.DATE_FLOOR,
    brands: Iterable[C.BrandSpec] = C.BRANDS,
) -> DataFrame:
    """Distinct cancelled chassis per snapshot day: full (any status) or partial (any
    benefit that is not active); active chassis are not excluded."""
    spans, days = span_tables(tables, start, end, more=["updated_at"])
    columns = dict.fromkeys((EVENT, BRAND, *SPAN, "chassi", "data_cancelamento", *[c for c, _ in LATEST]))
    events = plate_events(
        spans, (C.FULL, C.PARTIAL), floor, statuses=None, closed_only=False, with_names=False,
        only=columns, stored="cancelled-events",
    )
    full = events.where(F.col(EVENT) == C.FULL)
    full = first_by_day(full, ["chassi", BRAND], latest_order(), len(days))
    full = full.where(P.date_floor(F.col("data_cancelamento"), floor))
    partial = events.where(F.col(EVENT) == C.PARTIAL)
    rows = full.select("chassi", *SPAN).unionByName(partial.select("chassi", *SPAN))
    counts = count_distinct_by_day(rows, "chassi", days, "cancelados")
    return per_snapshot_day(tables, counts, "cancelados", start, end, brands)


def active_on_day(tables: Tables, day: dt.date) -> DataFrame:
    """Deduplicated active base of one snapshot day, latest start first.

    Ties on the start date: latest registration, then brand order.
    """
    tables = _between(tables, day, day)
    start_first = [("inicio_vig", "desc"), ("data_registro", "desc")]
    row_id = [("conjunto", "desc"), ("coverage_id", "asc")]
    sets = contract_sets(tables, P.set_is_active(F.col("status_id")))
    rows = coverages(tables, P.benefit_is_active(F.col("status_beneficio")))
    rows = bridged_trailers(sets_with_coverages(sets, rows), tables)
    rows = vehicle_or_trailer(reduce_plates(rows, [*start_first, *row_id]), tables)
    rows = rows.where(P.identity_not_null(F.col("placa"), F.col("chassi")))
    rows = unit_lookup(customer_lookup(rows, tables), tables)
    order = [
        *start_first,
        (X.brand_rank(), "asc"),
        *row_id,
        *[(c, "asc") for c in ("id_carroceria", "id_placa", *NAME_COLUMNS[:2])],
    ]
    rows = keep_first(rows, ["chassi", DAY], order)
    return rows.select(
        "placa",
        "chassi",
        "matricula",
        "unidade",
        F.col("status").alias("status_conjunto"),
        "cliente",
        "inicio_vig",
        F.col("ativado_em").alias("data_ativacao"),
        BRAND,
    )
