"""The reports as named queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from placaflow import config as C
from placaflow.functions.calendar import reporting_window
from placaflow.plans import adhoc, backfill, daily, detail, kpi, rankings
from placaflow.standin import tables as S
from placaflow.standin.oracle import FLOOR as FLOOR_SQL
from placaflow.standin.oracle import FRIDAY, MONDAY, SUNDAY, brand_no
from placaflow.standin.registry import FLOOR, RUN_DATE, WEEKDAY_RUN, Source, query, window

_COVERAGE_KEY = ("chassi", "empresa", "coverage_id")
UNIT_CANCEL_DAY = dt.date(2001, 7, 27)
SOME_UNITS = ("Unidade NATION_5", "Unidade NATION_10", "Franqueado NATION_1", "NATION_7")
_UNITS_SQL = ", ".join(f"'{u}'" for u in SOME_UNITS)
_PERIOD = f"BETWEEN {FRIDAY} AND {SUNDAY}"
_CUSTOM = "BETWEEN DATE '2001-06-30' AND DATE '2001-07-29'"


def _events(s: Source, *kinds: str, **options) -> DataFrame:
    """Plate events for one report."""
    return detail.plate_events(s.tables, kinds or C.KINDS, FLOOR, **options)


def _active(s: Source, **options) -> DataFrame:
    return detail.active_plates(_events(s, C.ACTIVE), RUN_DATE, **options)


def _narrow_active(s: Source) -> DataFrame:
    """Active base without names and order: all that the counts need."""
    return detail.active_plates(
        _events(s, C.ACTIVE, with_names=False), RUN_DATE, ordered=False
    )


def _counted(s: Source) -> tuple[DataFrame, DataFrame]:
    """Active and consolidated base for counting, from one pass over the tables."""
    return daily.counted_bases(s.tables, RUN_DATE, FLOOR)


def cancelled(s: Source, **options) -> DataFrame:
    events = daily.stored_events(s.tables, FLOOR, with_names=True)
    return detail.consolidated_cancellations(events, RUN_DATE, floor=FLOOR, **options)


# Detail bases --------------------------------------------------------------------


@query("active_plates", "SELECT * FROM active")
def active_plates(s: Source) -> DataFrame:
    return _active(s)


@query(
    "active_plates_by_start",
    f"""SELECT upper(placa) AS placa, upper(chassi) AS chassi, plate_id AS id_placa,
    veh_id AS id_veiculo, bri_id AS id_carroceria, reg_id AS matricula, set_id AS conjunto,
    renewed AS conjunto_renovado, upper(unidade) AS unidade, upper(consultor) AS consultor,
    upper(set_status) AS status_conjunto, upper(cliente) AS cliente,
    upper(usuario_suporte) AS usuario_suporte, reg_ts AS data_registro, start_day AS inicio_vig,
    act_day AS data_ativacao, {MONDAY} AS data_extracao, upper(empresa) AS empresa
    FROM (SELECT *, row_number() OVER (PARTITION BY chassi
        ORDER BY start_day DESC, act_day DESC, {brand_no('empresa')}) AS r2
        FROM active_ranked WHERE r1 = 1) WHERE r2 = 1""",
)
def active_plates_by_start(s: Source) -> DataFrame:
    return _active(s, prefer="effective_start")


_CANCELLED_SQL = """upper(placa) AS placa, upper(chassi) AS chassi, plate_id AS id_placa,
    veh_id AS id_veiculo, bri_id AS id_carroceria, reg_id AS matricula, set_id AS conjunto,
    upper(unidade) AS unidade, upper(consultor) AS consultor, upper(set_status) AS status,
    upper(cliente) AS cliente, upper(usuario_suporte) AS usuario_suporte,
    upper(canceller) AS usuario_cancelamento, cov_id AS coverage_id, upper(beneficio) AS beneficio,
    upper(ben_status) AS status_beneficio, DATE '2001-07-30' AS data_extracao,
    reg_ts AS data_registro, start_day AS data_ativacao, ben_start AS data_ativacao_beneficio,
    upper(empresa) AS empresa"""


@query(
    "full_cancellations",
    f"""SELECT {_CANCELLED_SQL}, cancel_day AS data_cancelamento
    FROM full_closed WHERE cancel_day >= {FLOOR_SQL}""",
)
def full_cancellations(s: Source) -> DataFrame:
    return detail.full_cancellations(_events(s, C.FULL), RUN_DATE, FLOOR)


@query(
    "full_cancellations_any_status",
    f"""SELECT {_CANCELLED_SQL}, cancel_day AS data_cancelamento
    FROM full_any WHERE cancel_day >= {FLOOR_SQL}""",
)
def full_cancellations_any_status(s: Source) -> DataFrame:
    events = _events(s, C.FULL, closed_only=False)
    return detail.full_cancellations(events, RUN_DATE, FLOOR)


@query(
    "partial_cancellations",
    f"""SELECT DISTINCT {_CANCELLED_SQL}, tick_ts AS data_cancelamento FROM partial_ended
    WHERE upper(chassi) NOT IN (SELECT upper(chassi) FROM active_pick)""",
)
def partial_cancellations(s: Source) -> DataFrame:
    return detail.partial_cancellations(s.tables, RUN_DATE, FLOOR)


@query(
    "partial_cancellations_with_active",
    f"SELECT DISTINCT {_CANCELLED_SQL}, tick_ts AS data_cancelamento FROM partial_ended",
)
def partial_cancellations_with_active(s: Source) -> DataFrame:
    return detail.partial_cancellations(s.tables, RUN_DATE, FLOOR, exclude_active=False)


@query(
    "partial_cancellations_any_ended",
    f"""SELECT DISTINCT {_CANCELLED_SQL}, tick_ts AS data_cancelamento FROM chain_ok
    WHERE sid = 7 AND ben_status <> 'ATIVO' AND tick_ts >= {FLOOR_SQL}""",
)
def partial_cancellations_any_ended(s: Source) -> DataFrame:
    return detail.partial_cancellations(
        s.tables, RUN_DATE, FLOOR, statuses=None, exclude_active=False
    )


@query("consolidated_cancellations", "SELECT * FROM cancelled")
def consolidated_cancellations(s: Source) -> DataFrame:
    return cancelled(s, invoices=s.invoices)


@query(
    "consolidated_by_coverage",
    f"""SELECT upper(chassi) AS chassi, upper(empresa) AS empresa, cov_id AS coverage_id,
    off_day AS data_cancelamento, kind AS identificador FROM (
        SELECT *, row_number() OVER (PARTITION BY upper(chassi), empresa, cov_id
            ORDER BY off_day DESC, kind, {brand_no('empresa')}, bri_id, plate_id) AS r3
        FROM cancel_all) WHERE r3 = 1""",
)
def consolidated_by_coverage(s: Source) -> DataFrame:
    rows = detail.all_cancellations(
        s.tables, RUN_DATE, FLOOR, _COVERAGE_KEY, exclude_active=False, with_names=False
    )
    return rows.select("chassi", "empresa", "coverage_id", "data_cancelamento", "identificador")


@query("delinquent_sets", "SELECT * FROM overdue")
def delinquent_sets(s: Source) -> DataFrame:
    return detail.delinquent_sets(s.invoices)


@query("period_cancellations", f"SELECT * FROM cancelled WHERE data_cancelamento {_PERIOD}")
def period_cancellations(s: Source) -> DataFrame:
    return detail.period_cancellations(cancelled(s, invoices=s.invoices), *window())


# Counts --------------------------------------------------------------------------


def _kpi_sql(period: str, extra: str = "") -> str:
    return f"""SELECT b.ordem, b.empresa,
    (SELECT count(*) FROM active a WHERE a.empresa = b.empresa AND a.inicio_vig {period})
        AS ativados,
    (SELECT count(*) FROM cancelled c WHERE c.empresa = b.empresa AND c.identificador = 'INTEGRAL'
        AND c.status = 'FINALIZADO' AND c.data_cancelamento {period}) AS finalizados,
    (SELECT count(*) FROM cancelled c WHERE c.empresa = b.empresa AND c.identificador = 'INTEGRAL'
        AND c.status = 'CANCELADO' AND c.data_cancelamento {period}) AS cancelados,
    (SELECT count(*) FROM cancelled c WHERE c.empresa = b.empresa AND c.identificador = 'PARCIAL'
        AND c.data_cancelamento {period}) AS beneficios_cancelados{extra}
    FROM brands b"""


@query("daily_kpis", _kpi_sql(_PERIOD))
def daily_kpis(s: Source) -> DataFrame:
    return kpi.daily_kpis(*_counted(s), window())


@query("daily_kpis_weekday", _kpi_sql("= DATE '2001-07-25'"))
def daily_kpis_weekday(s: Source) -> DataFrame:
    days = reporting_window(WEEKDAY_RUN)
    return kpi.daily_kpis(*_counted(s), days)


@query("daily_kpis_friday_only", _kpi_sql(f"= {FRIDAY}"))
def daily_kpis_friday_only(s: Source) -> DataFrame:
    return kpi.daily_kpis(*_counted(s), window("friday_only"))


@query("daily_kpis_custom", _kpi_sql(_CUSTOM))
def daily_kpis_custom(s: Source) -> DataFrame:
    return kpi.daily_kpis(*_counted(s), window("custom"))


REPORT_SQL = f"""SELECT ordem, empresa, ativados, finalizados, cancelados, beneficios_cancelados,
    '27/07/2001 (sexta) - 29/07/2001 (domingo)' AS periodo,
    (SELECT replace(format('{{:,}}', count(DISTINCT chassi)), ',', '.') FROM active
        WHERE inicio_vig <= {SUNDAY}) AS total_ativos
    FROM (SELECT * FROM ({_kpi_sql(_PERIOD)}) k
    UNION ALL SELECT 5, 'Total', CAST(sum(ativados) AS BIGINT), CAST(sum(finalizados) AS BIGINT),
        CAST(sum(cancelados) AS BIGINT), CAST(sum(beneficios_cancelados) AS BIGINT)
        FROM ({_kpi_sql(_PERIOD)}) t)"""


@query("report_summary", REPORT_SQL)
def report_summary(s: Source) -> DataFrame:
    return kpi.report_summary(*_counted(s), window())


_HISTORY_DAYS = "(SELECT day FROM snap_days WHERE day BETWEEN DATE '2001-07-27' AND DATE '2001-07-29')"


def history_sql(column: str = "inicio_vig") -> str:
    return f"""SELECT h.day AS data,
    (SELECT count(DISTINCT chassi) FROM active a WHERE a.{column} <= h.day) AS qtd_ativos,
    (SELECT count(*) FROM active a WHERE a.inicio_vig = h.day) AS ativados,
    (SELECT count(*) FROM cancelled c WHERE c.data_cancelamento = h.day) AS cancelados
    FROM {_HISTORY_DAYS} h"""


@query("daily_history", history_sql())
def daily_history(s: Source) -> DataFrame:
    return kpi.daily_history(*_counted(s), window())


@query(
    "daily_history_markers",
    f"""SELECT data, CASE isodow(data) WHEN 6 THEN 'SÁBADO' WHEN 7 THEN 'DOMINGO'
    ELSE CAST(qtd_ativos AS VARCHAR) END AS qtd_ativos FROM ({history_sql('data_ativacao')})""",
)
def daily_history_markers(s: Source) -> DataFrame:
    history = kpi.daily_history(*_counted(s), window(), active_column="data_ativacao")
    return kpi.marked_history(history)


@query(
    "period_totals",
    f"""SELECT (SELECT count(*) FROM active WHERE inicio_vig {_CUSTOM}) AS total_ativados,
    (SELECT count(*) FROM cancelled WHERE data_cancelamento {_CUSTOM}) AS total_cancelados""",
)
def period_totals(s: Source) -> DataFrame:
    return kpi.period_totals(*_counted(s), window("custom"))


def _as_of_sql(column: str) -> str:
    return f"""SELECT h.day AS data, (SELECT count(DISTINCT chassi) FROM active a
    WHERE a.{column} <= h.day) AS qtd_ativos FROM {_HISTORY_DAYS} h"""


@query("active_as_of", _as_of_sql("inicio_vig"))
def active_as_of(s: Source) -> DataFrame:
    days = [dt.date(2001, 7, d) for d in (27, 28, 29)]
    return kpi.active_as_of(_narrow_active(s), days)


@query("active_as_of_activation", _as_of_sql("data_ativacao"))
def active_as_of_activation(s: Source) -> DataFrame:
    days = [dt.date(2001, 7, d) for d in (27, 28, 29)]
    return kpi.active_as_of(_narrow_active(s), days, "data_ativacao")


@query(
    "per_day_counts",
    f"""SELECT h.day AS data,
    (SELECT count(*) FROM active a WHERE a.inicio_vig = h.day) AS ativados,
    (SELECT count(*) FROM cancelled c WHERE c.data_cancelamento = h.day) AS cancelados
    FROM {_HISTORY_DAYS} h""",
)
def per_day_counts(s: Source) -> DataFrame:
    return kpi.per_day_counts(*_counted(s), window())


_SIMPLE = f"""SELECT b.empresa,
    (SELECT count(*) FROM (SELECT *, row_number() OVER (PARTITION BY chassi
        ORDER BY start_day DESC, act_day DESC, {brand_no('empresa')}) AS r2
        FROM active_ranked WHERE r1 = 1) a
        WHERE r2 = 1 AND upper(a.empresa) = b.empresa AND a.start_day = {FRIDAY}) AS ativados,
    (SELECT count(*) FROM full_closed c WHERE upper(c.empresa) = b.empresa
        AND c.cancel_day = {FRIDAY} AND c.cancel_day >= {FLOOR_SQL}) AS cancelados
    FROM brands b"""


@query(
    "simple_brand_totals",
    f"""SELECT * FROM ({_SIMPLE}) x UNION ALL SELECT 'Total', CAST(sum(ativados) AS BIGINT),
    CAST(sum(cancelados) AS BIGINT) FROM ({_SIMPLE}) y""",
)
def simple_brand_totals(s: Source) -> DataFrame:
    events = _events(s, C.ACTIVE, with_names=False)
    active = detail.active_plates(events, RUN_DATE, prefer="effective_start", ordered=False)
    # Partial rows have no date in this report, so that only full ones can fall into a window.
    full = detail.full_cancellations(_events(s, C.FULL, with_names=False), RUN_DATE, FLOOR)
    return kpi.simple_brand_totals(active, full, window("friday_only"))


@query(
    "cancelled_plates_of_day",
    f"""SELECT DISTINCT upper(placa) AS placa FROM full_closed
    WHERE cancel_day = {FRIDAY} AND cancel_day >= {FLOOR_SQL}""",
)
def cancelled_plates_of_day(s: Source) -> DataFrame:
    full = detail.full_cancellations(_events(s, C.FULL, with_names=False), RUN_DATE, FLOOR)
    return kpi.cancelled_plates_of_day(full, window("friday_only")[0])


# Rankings ------------------------------------------------------------------------


def _top_sql(kind: str, table: str, date: str) -> str:
    return f"""SELECT '{kind}' AS tipo, unidade, chassis FROM (
    SELECT coalesce(unidade, 'N/A') AS unidade, count(DISTINCT chassi) AS chassis
    FROM {table} WHERE {date} {_CUSTOM} GROUP BY 1 ORDER BY chassis DESC, unidade LIMIT 20)"""


@query(
    "units_ranking",
    _top_sql("ATIVACOES", "active", "inicio_vig")
    + " UNION ALL "
    + _top_sql("CANCELAMENTOS", "cancelled", "data_cancelamento"),
)
def units_ranking(s: Source) -> DataFrame:
    events = daily.stored_events(s.tables, FLOOR, with_names=True)
    active = detail.active_plates(events, RUN_DATE, ordered=False)
    cancelled = detail.consolidated_cancellations(events, RUN_DATE, floor=FLOOR)
    return rankings.units_ranking(active, cancelled, window("custom"))


@query(
    "units_ranking_all_rows",
    f"""SELECT coalesce(upper(unidade), 'N/A') AS unidade, count(DISTINCT upper(chassi)) AS chassis
    FROM cancel_left WHERE off_day {_CUSTOM} GROUP BY 1""",
)
def units_ranking_all_rows(s: Source) -> DataFrame:
    """Older notebooks count before the choice per chassis (their dedupe had no effect)."""
    rows = detail.all_cancellations(s.tables, RUN_DATE, FLOOR)
    return rankings.chassis_by_unit(rows, "data_cancelamento", window("custom"))


@query(
    "top_units_by_client",
    f"""SELECT g.unidade, g.cliente, g.chassis, g.unidade || ' - ' || g.cliente AS rotulo, t.total
    FROM (SELECT coalesce(unidade, 'N/A') AS unidade, coalesce(cliente, 'N/A') AS cliente,
        count(DISTINCT chassi) AS chassis FROM cancelled
        WHERE data_cancelamento {_CUSTOM} GROUP BY 1, 2) g
    JOIN (SELECT unidade, CAST(sum(chassis) AS BIGINT) AS total FROM (
        SELECT coalesce(unidade, 'N/A') AS unidade, coalesce(cliente, 'N/A') AS cliente,
        count(DISTINCT chassi) AS chassis FROM cancelled
        WHERE data_cancelamento {_CUSTOM} GROUP BY 1, 2)
        GROUP BY 1 ORDER BY total DESC, unidade LIMIT 4) t ON t.unidade = g.unidade""",
)
def top_units_by_client(s: Source) -> DataFrame:
    return rankings.top_units_by_client(cancelled(s), window("custom"))


# Ad-hoc listings -------------------------------------------------------------------


@query(
    "master_listing",
    """SELECT DISTINCT cov_id AS coverage, beneficio, placa, chassi, plate_id AS id_placa,
    reg_id AS matricula, set_id AS conjunto, set_status AS status, start_day AS data_ativacao,
    reg_ts AS data_registro, renewed AS id_renovacao, ben_start AS data_ativacao_beneficio,
    tick_ts AS data_atualizacao, ben_status AS status_beneficio, empresa FROM chain_ok""",
)
def master_listing(s: Source) -> DataFrame:
    return adhoc.master_listing(s.tables)


@query(
    "cancelled_plates_by_unit",
    f"""SELECT CASE WHEN unit_nome LIKE '%FTR%' THEN unit_nome ELSE unidade END AS unidade,
    count(DISTINCT placa_2) AS quantidade_placas, empresa FROM chain
    WHERE cancel_day = DATE '{UNIT_CANCEL_DAY}' GROUP BY 1, 3""",
)
def cancelled_plates_by_unit(s: Source) -> DataFrame:
    return adhoc.cancelled_plates_by_unit(s.tables, UNIT_CANCEL_DAY)


@query(
    "unit_search",
    """SELECT DISTINCT upper(u.fantasia) AS unidade, u.nome, u.doc AS cnpj_cpf,
    lower(s.empresa) AS empresa FROM sets s LEFT JOIN units u ON u.unit_id = s.unit_id
    WHERE upper(u.nome) LIKE '%DIGITAL%'""",
)
def unit_search(s: Source) -> DataFrame:
    return adhoc.unit_search(s.tables)


@query(
    "unit_search_by_trade_name",
    """SELECT DISTINCT u.fantasia AS unidade, lower(s.empresa) AS empresa
    FROM sets s LEFT JOIN units u ON u.unit_id = s.unit_id WHERE u.fantasia LIKE '%Franq%'""",
)
def unit_search_by_trade_name(s: Source) -> DataFrame:
    return adhoc.unit_search_by_trade_name(s.tables, "Franq")


@query(
    "benefit_catalogue",
    """SELECT DISTINCT b.benefit_id AS id_beneficio, b.beneficio, w.empresa FROM benefit_of b
    JOIN (VALUES ('segtruck', 2), ('segtruck', 3), ('segtruck', 4),
        ('tag', 2), ('tag', 3), ('tag', 4)) AS w(empresa, id) ON w.id = b.benefit_id""",
)
def benefit_catalogue(s: Source) -> DataFrame:
    return adhoc.benefit_catalogue(s.tables)


# Snapshot backfills ------------------------------------------------------------------

_ON_DAY = "JOIN snaps n ON CAST(c.reg_ts AS DATE) <= n.day"


def _per_day(body: str, measure: str, tables: int = 7) -> str:
    """One row per calendar day around counts `n` per snapshot day; on the missing day all
    tables that the report reads are missing, of four brands."""
    return f"""SELECT d.day AS data, coalesce(x.n, 0) AS {measure},
    d.day <> DATE '2001-07-25' AS has_snapshot,
    CAST(CASE WHEN d.day = DATE '2001-07-25' THEN {4 * tables} ELSE 0 END AS BIGINT) AS missing_tables
    FROM snap_days d LEFT JOIN ({body}) x ON x.day = d.day"""


@query(
    "backfill_active",
    _per_day(
        f"""SELECT n.day, count(DISTINCT c.chassi) AS n FROM chain_ok c {_ON_DAY}
    WHERE c.sid = 7 AND c.ben_status = 'ATIVO' GROUP BY 1""",
        "ativos",
    ),
)
def backfill_active(s: Source) -> DataFrame:
    return backfill.backfill_active(s.snapshots, S.SNAPSHOT_START, S.SNAPSHOT_END)


def _windowed(where: str, date: str, measure: str, tables: int = 7) -> str:
    return _per_day(
        f"""SELECT l.day, count(*) FILTER (WHERE l.latest BETWEEN w.w0 AND w.w1) AS n FROM (
        SELECT n.day, c.chassi, max({date}) AS latest FROM chain c {_ON_DAY}
        WHERE {where} GROUP BY 1, 2) l JOIN snap_windows w ON w.day = l.day GROUP BY 1""",
        measure,
        tables,
    )


@query(
    "backfill_activated",
    _windowed("c.sid = 7 AND c.ben_status = 'ATIVO'", "c.start_day", "total_ativados"),
)
def backfill_activated(s: Source) -> DataFrame:
    return backfill.backfill_activated(s.snapshots, S.SNAPSHOT_START, S.SNAPSHOT_END)


@query(
    "backfill_activated_by_unit",
    _windowed(
        f"c.sid = 7 AND c.ben_status = 'ATIVO' AND c.unidade IN ({_UNITS_SQL})",
        "c.start_day",
        "total_ativados",
        tables=9,
    ),
)
def backfill_activated_by_unit(s: Source) -> DataFrame:
    return backfill.backfill_activated(
        s.snapshots, S.SNAPSHOT_START, S.SNAPSHOT_END, units=SOME_UNITS
    )


_CANCELLED_SETS = "c.set_status IN ('CANCELADO', 'CANCELADO_PARCIAL')"


@query(
    "backfill_cancelled",
    _windowed(_CANCELLED_SETS, "CAST(c.eff_to AS DATE)", "total_cancelados"),
)
def backfill_cancelled(s: Source) -> DataFrame:
    return backfill.backfill_cancelled(s.snapshots, S.SNAPSHOT_START, S.SNAPSHOT_END)


@query(
    "backfill_cancelled_by_unit",
    _windowed(
        f"{_CANCELLED_SETS} AND c.unidade IN ({_UNITS_SQL})",
        "CAST(c.eff_to AS DATE)",
        "total_cancelados",
        tables=9,
    ),
)
def backfill_cancelled_by_unit(s: Source) -> DataFrame:
    return backfill.backfill_cancelled(
        s.snapshots, S.SNAPSHOT_START, S.SNAPSHOT_END, units=SOME_UNITS
    )


@query(
    "backfill_cancellations",
    _per_day(
        f"""SELECT day, count(DISTINCT chassi) AS n FROM (
        SELECT day, chassi FROM (SELECT n.day, c.chassi, c.cancel_day, row_number() OVER (
            PARTITION BY n.day, c.empresa, c.chassi ORDER BY c.reg_ts DESC, c.set_id DESC) AS r
            FROM chain_ok c {_ON_DAY} WHERE c.cancel_ts IS NOT NULL)
        WHERE r = 1 AND cancel_day >= {FLOOR_SQL}
        UNION ALL SELECT n.day, c.chassi FROM chain_ok c {_ON_DAY}
        WHERE c.sid = 7 AND c.ben_status <> 'ATIVO' AND c.tick_ts >= {FLOOR_SQL}) GROUP BY 1""",
        "cancelados",
    ),
)
def backfill_cancellations(s: Source) -> DataFrame:
    return backfill.backfill_cancellations(
        s.snapshots, S.SNAPSHOT_START, S.SNAPSHOT_END, FLOOR
    )


@query(
    "export_active_day",
    f"""SELECT placa, chassi, reg_id AS matricula, unidade, set_status AS status_conjunto, cliente,
    start_day AS inicio_vig, act_day AS data_ativacao, empresa FROM (
        SELECT *, row_number() OVER (PARTITION BY chassi ORDER BY start_day DESC, reg_ts DESC,
            {brand_no('empresa')}, set_id DESC, cov_id, bri_id, plate_id) AS r FROM chain_ok
        WHERE sid = 7 AND ben_status = 'ATIVO'
        AND CAST(reg_ts AS DATE) <= DATE '2001-07-28') WHERE r = 1""",
)
def export_active_day(s: Source) -> DataFrame:
    return backfill.active_on_day(s.snapshots, dt.date(2001, 7, 28))
