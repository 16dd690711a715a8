"""Detail bases: active plates, full, partial and consolidated cancellations.

`plate_events` reads the contract chain once and tags its rows: ATIVO (active benefit
of an active set), INTEGRAL (cancelled set), PARCIAL (ended benefit of an active set).
It keeps one row per plate reference, brand and tag. All reports that show one row per
chassis are choices among these rows; a job that needs several of them materialises
the events first (see `plans.daily`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placaflow import config as C
from placaflow.functions import expressions as X
from placaflow.functions import predicates as P
from placaflow.operators.dedupe import keep_first
from placaflow.operators.joins import BRAND, DAY, exclude_keys, flag_membership, scope_of
from placaflow.operators.ordering import order_rows
from placaflow.operators.sets import union_by_name
from placaflow.plans.base import (
    NAME_COLUMNS,
    PLATE_REFERENCE,
    Tables,
    bridged_trailers,
    contract_base,
    contract_rows,
    contract_sets,
    coverages,
    names,
    reduce_plates,
    sets_with_coverages,
    steps_over,
    vehicle_or_trailer,
)
from placaflow.session import materialise

EVENT = "evento"

# "Latest registration" made total: later set, then first benefit, then the plate ids.
LATEST = (
    ("data_registro", "desc"),
    ("conjunto", "desc"),
    ("coverage_id", "asc"),
    ("id_carroceria", "asc"),
    ("id_placa", "asc"),
)
#: Columns that the events are made by, and that are none of theirs.
_READ_ON_THE_WAY = (
    EVENT, *[c for c, _ in LATEST], *PLATE_REFERENCE, "set_id", "updated_at", "status_beneficio", "placa", "chassi",
)
_TICK_DAY = f"div(updated_at - {C.TICKS_AT_1900}, {C.TICKS_PER_DAY})"

# All that the counts read.
COUNT_COLUMNS = (
    EVENT, BRAND, "placa", "chassi", "conjunto", "coverage_id", "id_carroceria", "id_placa",
    "status", "data_registro", "inicio_vig", "ativado_em", "data_cancelamento", "updated_at",
)


def latest_order(brand_first: bool = False, named: Iterable[str] = ()) -> list[tuple[str, str]]:
    """`LATEST`, brands in report order right after the date; names settle what is left."""
    order = list(LATEST)
    if brand_first:
        order.insert(1, (X.brand_rank(), "asc"))
    return [*order, *[(c, "asc") for c in named]]


def _names_in(df: DataFrame) -> list[str]:
    return [c for c in (*NAME_COLUMNS, "beneficio") if c in df.columns]


def days_of(df: DataFrame) -> list[str]:
    """The snapshot-day column, where the frame has one."""
    return [c for c in scope_of(df) if c == DAY]


# Events ------------------------------------------------------------------------------


def _event_rules(
    floor: dt.date, statuses: Iterable[str] | None, closed_only: bool
) -> dict[str, tuple[Column, Column | None]]:
    """Per event: the condition on the set and the one on the coverage."""
    set_active = P.set_is_active(F.col("status_id"))
    benefit = F.col("status_beneficio")
    cancelled = P.cancel_date_not_null(F.col("date_cancellation"))
    ended = (
        P.benefit_status_not(benefit)
        if statuses is None
        else P.benefit_status_in(benefit, statuses)
    )
    return {
        C.ACTIVE: (set_active, P.benefit_is_active(benefit)),
        C.FULL: (
            cancelled & P.set_status_not_in(F.col("status")) if closed_only else cancelled,
            None,
        ),
        C.PARTIAL: (set_active, ended & P.tick_floor(F.col("updated_at"), floor)),
    }


def plate_events(
    tables: Tables,
    events: Iterable[str] = C.KINDS,
    floor: dt.date = C.DATE_FLOOR,
    statuses: Iterable[str] | None = C.PARTIAL_BENEFIT_STATUSES,
    closed_only: bool = True,
    with_names: bool = True,
    only: Iterable[str] | None = None,
    stored: str | None = None,
) -> DataFrame:
    """One row per plate reference, brand and event: the one any report could choose.

    `floor` concerns partial events only; full ones are cut after the choice per
    chassis. `statuses=None`: every benefit that is not active counts as ended.
    `closed_only` leaves out cancelled sets whose status is still open (or unknown).
    `only` names the columns that are read, `stored` a folder that the events are written to.
    """
    events = list(events)
    rules = {e: r for e, r in _event_rules(floor, statuses, closed_only).items() if e in events}
    on_set = [set_rule for set_rule, _ in rules.values()]
    on_coverage = [rule for _, rule in rules.values() if rule is not None]

    flags = {f"is_set_{e}": rule for e, (rule, _) in rules.items()}
    sets = contract_sets(tables, _any(on_set), flags if len(rules) > 1 else None)
    # An event without a coverage rule needs every coverage.
    wanted = _any(on_coverage) if len(on_coverage) == len(rules) else None
    only = None if only is None else list(only)
    steps = steps_over(tables, only and {*only, *flags, *_READ_ON_THE_WAY, *scope_of(sets)})
    rows = contract_rows(sets, tables, wanted, steps)
    if len(rules) == 1:
        rows = rows.withColumn(EVENT, F.lit(events[0]))
    else:
        # A row may count for several events; each gets its own copy.
        found = [
            F.when(
                F.col(f"is_set_{e}") if rule is None else F.col(f"is_set_{e}") & rule, F.lit(e)
            )
            for e, (_, rule) in rules.items()
        ]
        rows = rows.withColumn(EVENT, F.explode(F.array_compact(F.array(*found))))
        rows = rows.drop(*flags)
    partial = f"{EVENT} = '{C.PARTIAL}'"
    rows = reduce_plates(
        rows,
        [
            (f"if({partial}, NULL, data_registro)", "desc"),
            (f"if({partial}, NULL, conjunto)", "desc"),
            (f"if({partial}, {_TICK_DAY}, NULL)", "desc"),
            ("coverage_id", "asc"),
        ],
        also=[EVENT],
    )
    rows = vehicle_or_trailer(steps.cut(rows, "references"), tables)
    rows = rows.where(P.identity_not_null(F.col("placa"), F.col("chassi")))
    if with_names:
        rows = names(steps.cut(rows, "plates"), tables, events != [C.ACTIVE], steps)
    if only is not None:
        rows = rows.select(*only)
    return rows if stored is None else steps.last(rows, stored, EVENT)


def _any(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def _event(events: DataFrame, event: str) -> DataFrame:
    return events.where(F.col(EVENT) == event)


# Choices among events ----------------------------------------------------------------


def latest_registration(rows: DataFrame) -> DataFrame:
    """Latest registration per chassis inside each brand."""
    return keep_first(rows, ["chassi", *scope_of(rows)], latest_order(named=_names_in(rows)))


def _columns(
    df: DataFrame, wanted: Iterable[str | tuple[str, str]], **computed: Column
) -> list[Column]:
    """Output columns in order; (source, name) renames; absent names are left out."""
    present = set(df.columns)
    out = []
    for item in wanted:
        source, name = item if isinstance(item, tuple) else (item, item)
        if name in computed:
            out.append(computed[name].alias(name))
        elif source in present:
            out.append(F.col(source).alias(name))
    return out


# The columns of the detail sets, in order.
_ACTIVE_COLUMNS = (
    DAY, "placa", "chassi", "id_placa", "id_veiculo", "id_carroceria", "matricula", "conjunto",
    "conjunto_renovado", "unidade", "consultor", ("status", "status_conjunto"), "cliente",
    "usuario_suporte", "data_registro", "inicio_vig", ("ativado_em", "data_ativacao"),
    "data_extracao", BRAND,
)

_CANCELLED_COLUMNS = (
    DAY, "placa", "chassi", "id_placa", "id_veiculo", "id_carroceria", "matricula", "conjunto",
    "unidade", "consultor", "status", "cliente", "usuario_suporte", "usuario_cancelamento",
    "coverage_id", "beneficio", "status_beneficio", "data_extracao", "data_registro",
    ("inicio_vig", "data_ativacao"), "data_ativacao_beneficio", "data_cancelamento", BRAND,
)


def active_plates(
    events: DataFrame, run_date: dt.date, prefer: str = "registration", ordered: bool = True
) -> DataFrame:
    """One row per chassis over all brands, upper-cased after the choice.

    prefer="registration": the latest registration wins across brands, ties in brand
    order. Per-brand and cross-brand choice are then one choice under the combined
    order. prefer="effective_start": the latest registration per brand, then the
    latest start date across brands (older reports).
    """
    rows = _event(events, C.ACTIVE)
    keys = ["chassi", *days_of(rows)]
    if prefer == "registration":
        rows = keep_first(rows, keys, latest_order(brand_first=True, named=_names_in(rows)))
    elif prefer == "effective_start":
        order = [("inicio_vig", "desc"), ("ativado_em", "desc"), (X.brand_rank(), "asc")]
        rows = keep_first(latest_registration(rows), keys, order)
    else:
        raise ValueError(f"unknown preference {prefer!r}")
    columns = _columns(rows, _ACTIVE_COLUMNS, data_extracao=F.lit(run_date))
    result = X.upper_all_strings(rows.select(*columns))
    if not ordered:
        return result
    # The set and the chassis tell equal dates apart, so that a range of them can be split.
    order = [("inicio_vig", "desc"), ("data_ativacao", "desc"), ("conjunto", "asc"), ("chassi", "asc")]
    return order_rows(result, order)


def active_chassis(events: DataFrame) -> DataFrame:
    """Distinct upper-cased chassis of the active base (no choice per chassis needed)."""
    rows = _event(events, C.ACTIVE)
    return rows.select(*days_of(rows), F.upper("chassi").alias("chassi")).distinct()


def full_cancellations(
    events: DataFrame, run_date: dt.date, floor: dt.date = C.DATE_FLOOR, upper: bool = True
) -> DataFrame:
    """Latest cancelled set per chassis and brand; the date floor applies after the choice."""
    rows = latest_registration(_event(events, C.FULL))
    rows = rows.where(P.date_floor(F.col("data_cancelamento"), floor))
    columns = _columns(rows, _CANCELLED_COLUMNS, data_extracao=F.lit(run_date))
    result = rows.select(*columns)
    return X.upper_all_strings(result) if upper else result


def _partial_columns(rows: DataFrame, run_date: dt.date) -> DataFrame:
    day = X.ticks_to_timestamp(F.col("updated_at"))
    rows = rows.select(
        *_columns(rows, _CANCELLED_COLUMNS, data_extracao=F.lit(run_date), data_cancelamento=day)
    )
    return rows


def active_and_ended(
    tables: Tables,
    floor: dt.date = C.DATE_FLOOR,
    statuses: Iterable[str] | None = C.PARTIAL_BENEFIT_STATUSES,
) -> DataFrame:
    """Every ended benefit of an active set, and one active row per plate reference.

    One pass over the coverages (and one for those without an id): both kinds hang on active sets. Of active rows, which only say
    that a plate is active, one per reference is left in every map task.
    """
    rules = _event_rules(floor, statuses, True)
    (set_rule, active), (_, ended) = rules[C.ACTIVE], rules[C.PARTIAL]
    sets = contract_sets(tables, set_rule)
    rows = bridged_trailers(sets_with_coverages(sets, coverages(tables, active | ended)), tables)
    kinds = [F.when(active, F.lit(C.ACTIVE)), F.when(ended, F.lit(C.PARTIAL))]
    rows = rows.withColumn(EVENT, F.explode(F.array_compact(F.array(*kinds))))
    own = f"if({EVENT} = '{C.PARTIAL}', struct({', '.join(c for c in rows.columns if c != EVENT)}), NULL)"
    rows = reduce_plates(rows, [("coverage_id", "asc"), ("conjunto", "asc")], also=[EVENT, own])
    rows = vehicle_or_trailer(rows, tables)
    return rows.where(P.identity_not_null(F.col("placa"), F.col("chassi")))


def partial_cancellations(
    tables: Tables,
    run_date: dt.date,
    floor: dt.date = C.DATE_FLOOR,
    statuses: Iterable[str] | None = C.PARTIAL_BENEFIT_STATUSES,
    exclude_active: bool = True,
    with_names: bool = True,
) -> DataFrame:
    """Every ended benefit of an active set, unless its chassis is still active anywhere.

    Active and ended rows come from one pass, written once; active chassis are left out by an
    anti-join, which Spark can split where one chassis has most rows, before names are looked up.
    """
    if exclude_active:
        both = materialise(active_and_ended(tables, floor, statuses), "active-and-ended", EVENT)
        rows = _event(both, C.PARTIAL).drop(EVENT).withColumn("chassi", F.upper("chassi"))
        rows = exclude_keys(rows, active_chassis(both), ["chassi", *days_of(rows)])
    else:
        set_rule, coverage_rule = _event_rules(floor, statuses, True)[C.PARTIAL]
        rows = contract_base(tables, set_where=set_rule, coverage_where=coverage_rule)
    if with_names:
        rows = names(rows, tables, benefit=True)
    return X.upper_all_strings(_partial_columns(rows, run_date).distinct())


def _latest_cancellation(rows: DataFrame, key: Iterable[str]) -> DataFrame:
    """Latest cancellation per key. Ties: full first, brand order, lowest coverage."""
    order = [
        ("data_cancelamento", "desc"),
        ("identificador", "asc"),
        (X.brand_rank(), "asc"),
        ("coverage_id", "asc"),
        ("id_carroceria", "asc"),
        ("id_placa", "asc"),
        *[(c, "asc") for c in _names_in(rows)],
    ]
    return keep_first(rows, [*key, *days_of(rows)], order)


def _tagged_union(full: DataFrame, partial: DataFrame) -> DataFrame:
    return union_by_name(
        [
            full.withColumn("identificador", F.lit(C.FULL)),
            partial.withColumn("identificador", F.lit(C.PARTIAL)),
        ]
    )


def consolidated_cancellations(
    events: DataFrame,
    run_date: dt.date,
    invoices: DataFrame | None = None,
    floor: dt.date = C.DATE_FLOOR,
    exclude_active: bool = True,
) -> DataFrame:
    """Full and partial cancellations, one row per chassis (the latest), tagged.

    The channel column comes with names, the overdue flag with invoices.
    """
    partial = X.upper_all_strings(_partial_columns(_event(events, C.PARTIAL), run_date))
    partial = partial.withColumn("data_cancelamento", F.col("data_cancelamento").cast("date"))
    if exclude_active:
        partial = exclude_keys(partial, active_chassis(events), ["chassi", *days_of(partial)])
    rows = _tagged_union(full_cancellations(events, run_date, floor), partial)
    return channel_and_overdue(_latest_cancellation(rows, ["chassi"]), invoices)


def all_cancellations(
    tables: Tables,
    run_date: dt.date,
    floor: dt.date = C.DATE_FLOOR,
    key: Iterable[str] = (),
    statuses: Iterable[str] | None = C.PARTIAL_BENEFIT_STATUSES,
    exclude_active: bool = True,
    with_names: bool = True,
    date_partials: bool = True,
) -> DataFrame:
    """Full cancellations and every ended benefit, as older reports listed them.

    `key` (chassi, empresa, coverage_id, say) keeps the latest row per key; without one
    all rows stay. `date_partials=False` leaves partial rows without a date.
    """
    events = plate_events(tables, [C.FULL], floor, with_names=with_names)
    full = full_cancellations(events, run_date, floor)
    partial = partial_cancellations(tables, run_date, floor, statuses, exclude_active, with_names)
    day = F.col("data_cancelamento").cast("date") if date_partials else F.lit(None).cast("date")
    rows = _tagged_union(full, partial.withColumn("data_cancelamento", day))
    key = list(key)
    return channel_and_overdue(_latest_cancellation(rows, key) if key else rows, None)


def channel_and_overdue(rows: DataFrame, invoices: DataFrame | None) -> DataFrame:
    """Sales channel of the unit, and whether the set is on the overdue list."""
    if "unidade" in rows.columns:
        rows = rows.withColumn("categoria_comercial", X.commercial_category(F.col("unidade")))
    if invoices is not None:
        rows = flag_membership(rows, delinquent_sets(invoices), "conjunto", "inadimplente_45")
        rows = rows.withColumn("inadimplente_45", X.flag_to_label(F.col("inadimplente_45")))
    return rows


def period_cancellations(cancellations: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return cancellations.where(P.period_mask(F.col("data_cancelamento"), start, end))


def delinquent_sets(invoices: DataFrame) -> DataFrame:
    """Open overdue invoices without a paid entry, without test and excluded members.

    Repeated invoices are reduced before the anti-join: a pointer is paid or open as a
    whole, so the order of the two steps does not matter, and a pointer that holds most
    rows is cut down early.
    """
    paid = invoices.where(P.paid_invoice(F.col("historico"))).select("ponteiro").distinct()
    open_rows = keep_first(
        invoices.where(P.open_invoice_only(F.col("historico"))),
        ["ponteiro", "conjunto", "matricula", "empresa"],
        [("associado", "asc")],
    )
    unpaid = exclude_keys(open_rows, paid, ["ponteiro"], null_safe=True)
    return unpaid.where(
        P.exclude_association(F.col("empresa"), F.col("associado"))
        & P.exclude_test_members(F.col("associado"))
    )
