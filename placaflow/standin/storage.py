"""Scans and sinks as named queries: written to the shared folder, then read back."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placaflow import config as C
from placaflow.operators.joins import BRAND, DAY, zero_fill
from placaflow.operators.sets import union_by_name
from placaflow.plans import backfill, daily, detail, kpi
from placaflow.schemas import SOURCE_SCHEMAS
from placaflow.session import new_folder
from placaflow.sources import scan, sinks
from placaflow.standin import tables as S
from placaflow.standin.oracle import FRIDAY, SUNDAY
from placaflow.standin.registry import FLOOR, RUN_DATE, Source, query, window
from placaflow.standin.reports import REPORT_SQL, history_sql

_SETS = "insurance_reg_set"
_TAG = C.BRANDS[3]


def _folder(s: Source, name: str) -> str:
    return f"{new_folder(s.spark, name)}/data"


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def _land(s: Source, name: str, brands=C.BRANDS, day: dt.date | None = None) -> str:
    """Brand folders of the set table, as of a day if one is given; the first brand's
    columns are all text."""
    root = _folder(s, name)
    rows = s.tables[_SETS]
    for brand in brands:
        df = rows.where(F.col(BRAND) == brand.label).drop(BRAND)
        df = _as_text(df) if brand is C.BRANDS[0] else df
        folder = scan.resolve(root, brand, _SETS)
        df.write.parquet(folder if day is None else f"{folder}/{DAY}={day}")
    return root


_SET_COLUMNS = """set_id AS id, reg_id AS parent, sid AS id_status, helper_id AS id_user_support,
    reg_ts AS data_registration, cancel_ts AS date_cancellation, canceller AS user_name_cancellation"""
_SET_NAMES = (
    "id", "parent", "id_status", "id_user_support", "data_registration", "date_cancellation",
    "user_name_cancellation",
)


def _typed(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(*_SET_NAMES, *extra).withColumn("id_status", F.col("id_status").cast("int"))


@query("scan_brand_tables", f"SELECT {_SET_COLUMNS}, empresa FROM sets")
def scan_brand_tables(s: Source) -> DataFrame:
    """Brand folders to one table; text ids and dates become typed."""
    return _typed(scan.load_tables(s.spark, _land(s, "brands"))[_SETS], BRAND)


@query(
    "brand_namespace_map",
    """SELECT set_id AS id, CASE empresa WHEN 'Segtruck' THEN 'vilesoft' ELSE lower(empresa) END
    AS pasta FROM sets""",
)
def brand_namespace_map(s: Source) -> DataFrame:
    """The folder each row was read from."""
    rows = scan.load_tables(s.spark, _land(s, "folders"))[_SETS]
    folder = F.create_map(*[F.lit(x) for b in C.BRANDS for x in (b.label, b.folder)])
    return rows.select("id", folder[F.col(BRAND)].alias("pasta"))


@query(
    "empty_table_fallback",
    """SELECT b.ordem, b.empresa, count(s.set_id) AS n FROM brands b LEFT JOIN sets s
    ON upper(s.empresa) = b.empresa AND s.empresa IN ('Segtruck', 'Tag') GROUP BY 1, 2""",
)
def empty_table_fallback(s: Source) -> DataFrame:
    """Two of the four brands have no snapshot files: they are read as empty tables."""
    day = S.SNAPSHOT_END
    root = _land(s, "some-brands", (C.BRANDS[0], _TAG), day)
    rows = scan.load_snapshots(s.spark, root, day, day)[_SETS]
    counts = rows.groupBy(F.upper(BRAND).alias(BRAND)).agg(F.count("*").alias("n"))
    return zero_fill(kpi.brand_spine(s.spark), counts, [BRAND])


@query(
    "normalise_ids",
    """SELECT CASE WHEN set_id % 11 <> 0 THEN set_id END AS id,
    CASE WHEN set_id % 13 <> 0 THEN reg_ts END AS data_registration, reg_id AS parent FROM sets""",
)
def normalise_ids(s: Source) -> DataFrame:
    """Ids and dates as text, some unreadable: those become null."""
    key = F.col("id")
    text = s.tables[_SETS].select(
        F.when(key % 11 == 0, F.concat(F.lit("x"), key.cast("string")))
        .otherwise(key.cast("string"))
        .alias("ID"),
        F.when(key % 13 == 0, "ontem")
        .otherwise(F.col("data_registration").cast("string"))
        .alias("data_registration"),
        F.col("parent").cast("string").alias("parent"),
    )
    schema = T.StructType([SOURCE_SCHEMAS[_SETS][n] for n in ("id", "data_registration", "parent")])
    return scan.normalise(text, schema)


def _by_brand(s: Source, rows: DataFrame):
    """Each brand with its rows, the brand column left out as in the brand's own files."""
    return [(b, rows.where(F.col(BRAND) == b.label).drop(BRAND)) for b in C.BRANDS]


@query(
    "scan_snapshot",
    f"""SELECT n.day AS landing_date, {_SET_COLUMNS}, c.empresa FROM sets c
    JOIN snaps n ON CAST(c.reg_ts AS DATE) <= n.day
    WHERE n.day BETWEEN DATE '2001-07-24' AND DATE '2001-07-26'""",
)
def scan_snapshot(s: Source) -> DataFrame:
    """Three days are asked for, one of them has no snapshot."""
    root = _folder(s, "snapshots")
    for brand, rows in _by_brand(s, s.snapshots[_SETS]):
        rows.write.partitionBy(DAY).parquet(scan.resolve(root, brand, _SETS))
    days = (dt.date(2001, 7, 24), dt.date(2001, 7, 26))
    return _typed(scan.load_snapshots(s.spark, root, *days)[_SETS], DAY, BRAND)


@query(
    "scan_snapshot_evolving",
    """SELECT DATE '2001-07-20' AS landing_date, set_id AS id, reg_id AS parent,
    CAST(NULL AS VARCHAR) AS user_name_cancellation, empresa FROM sets
    UNION ALL SELECT DATE '2001-07-21', set_id, reg_id, canceller, empresa FROM sets""",
)
def scan_snapshot_evolving(s: Source) -> DataFrame:
    """The second day's files have a column that the first day's lack."""
    root = _folder(s, "evolving")
    first, second = dt.date(2001, 7, 20), dt.date(2001, 7, 21)
    for brand, rows in _by_brand(s, s.tables[_SETS]):
        path = scan.resolve(root, brand, _SETS)
        rows.drop("user_name_cancellation").write.parquet(f"{path}/{DAY}={first}")
        rows.write.parquet(f"{path}/{DAY}={second}")
    scanned = scan.load_snapshots(s.spark, root, first, second)[_SETS]
    return scanned.select(DAY, "id", "parent", "user_name_cancellation", BRAND)


@query(
    "scan_snapshot_by_day",
    """SELECT DATE '2001-07-20' AS landing_date, set_id AS id, reg_ts AS data_registration, empresa
    FROM sets UNION ALL SELECT DATE '2001-07-22', set_id, reg_ts, empresa FROM sets""",
)
def scan_snapshot_by_day(s: Source) -> DataFrame:
    """One day holds text where the other holds numbers; the day between has no files."""
    root = _folder(s, "drifting")
    first, last = dt.date(2001, 7, 20), dt.date(2001, 7, 22)
    for brand, rows in _by_brand(s, s.tables[_SETS]):
        path = scan.resolve(root, brand, _SETS)
        _as_text(rows).write.parquet(f"{path}/{DAY}={first}")
        rows.write.parquet(f"{path}/{DAY}={last}")
    scanned = scan.load_snapshots(s.spark, root, first, last, by_day=True)[_SETS]
    return scanned.select(DAY, "id", "data_registration", BRAND)


@query(
    "sample_table",
    "SELECT s_suppkey AS codigo, s_name AS descricao FROM supplier ORDER BY s_suppkey LIMIT 5",
)
def sample_table(s: Source) -> DataFrame:
    rows, columns = scan.sample_table(s.tables["vendedor"].orderBy("codigo"))
    return rows.select(*columns)


@query(
    "run_sql_file",
    """SELECT s.empresa, u.fantasia AS unidade, count(DISTINCT s.set_id) AS conjuntos,
    count(k.cov_id) AS coberturas FROM sets s LEFT JOIN units u ON u.unit_id = s.unit_id
    LEFT JOIN covers k ON k.set_id = s.set_id AND k.empresa = s.empresa
    WHERE s.sid = 7 GROUP BY 1, 2""",
)
def run_sql_file(s: Source) -> DataFrame:
    """SQL text from a file, on registered views, with parameters."""
    names = (_SETS, "insurance_reg_set_coverage", "representante", "catalogo")
    scan.register_views({name: s.tables[name] for name in names})
    path = Path(__file__).parent.parent / "sql" / "active_by_unit.sql"
    return scan.run_sql_file(s.spark, path, status=C.ACTIVE_SET_STATUS_ID)


# Sinks -------------------------------------------------------------------------------


_OF_PERIOD = f"FROM cancelled WHERE data_cancelamento BETWEEN {FRIDAY} AND {SUNDAY}"


@query(
    "sink_detail",
    f"""SELECT 'ativos' AS saida, * FROM active
    UNION ALL BY NAME SELECT 'cancelamentos' AS saida, * FROM cancelled
    UNION ALL BY NAME SELECT 'cancelamentos_periodo' AS saida, * {_OF_PERIOD}""",
)
def sink_detail(s: Source) -> DataFrame:
    """The three detail sets with all their columns."""
    path = _folder(s, "detalhes")
    events = daily.stored_events(s.tables, FLOOR, with_names=True)
    cancelled = detail.consolidated_cancellations(events, RUN_DATE, s.invoices, FLOOR)
    details = {
        "ativos": detail.active_plates(events, RUN_DATE),
        "cancelamentos": cancelled,
        "cancelamentos_periodo": detail.period_cancellations(cancelled, *window()),
    }
    for name, rows in details.items():
        sinks.write_detail(rows, f"{path}/{name}")
    read = [
        s.spark.read.parquet(f"{path}/{name}").select(F.lit(name).alias("saida"), "*")
        for name in details
    ]
    return union_by_name(read, allow_missing=True)


@query(
    "run_daily",
    f"""SELECT 'ativos' AS saida, count(*) AS linhas FROM active
    UNION ALL SELECT 'cancelamentos', count(*) FROM cancelled
    UNION ALL SELECT 'cancelamentos_periodo', count(*) {_OF_PERIOD}
    UNION ALL SELECT 'relatorio', count(*) FROM ({REPORT_SQL}) r
    UNION ALL SELECT 'base', count(*) FROM ({history_sql()}) h
    UNION ALL SELECT 'arquivo/latest', count(*) FROM ({REPORT_SQL}) r
    UNION ALL SELECT 'planilhas/ativos', count(*) FROM active
    UNION ALL SELECT 'planilhas/cancelamentos', count(*) FROM cancelled
    UNION ALL SELECT 'planilhas/cancelamentos_periodo', count(*) {_OF_PERIOD}""",
)
def run_daily(s: Source) -> DataFrame:
    """The daily job with all its sinks: rows that each of them holds afterwards."""
    out = _folder(s, "dia")
    daily.run_daily(s.tables, s.invoices, RUN_DATE, out, FLOOR, sheets=True)
    out = sinks.published_run(s.spark, out)
    details = ("ativos", "cancelamentos", "cancelamentos_periodo")
    written = {name: s.spark.read.parquet(f"{out}/{name}") for name in (*details, "relatorio", "base")}
    written["arquivo/latest"] = s.spark.read.parquet(f"{out}/arquivo/latest")
    for name in details:
        sheet = f"planilhas/{name}"
        written[sheet] = s.spark.read.option("header", True).csv(f"{out}/{sheet}")
    return union_by_name(
        df.agg(F.count("*").alias("linhas")).select(F.lit(name).alias("saida"), "linhas")
        for name, df in written.items()
    )


@query("sink_daily_history", history_sql())
def sink_daily_history(s: Source) -> DataFrame:
    """Written twice: a rerun replaces its days."""
    path = _folder(s, "base")
    history = kpi.daily_history(*daily.counted_bases(s.tables, RUN_DATE, FLOOR), window())
    sinks.write_history(history, path)
    sinks.write_history(history, path)
    return s.spark.read.parquet(path)


@query("sink_report", REPORT_SQL)
def sink_report(s: Source) -> DataFrame:
    path = _folder(s, "relatorio")
    report = kpi.report_summary(*daily.counted_bases(s.tables, RUN_DATE, FLOOR), window())
    sinks.write_report(report, path)
    return s.spark.read.parquet(path)


@query(
    "sink_dated_archive",
    f"SELECT v.copia, r.* FROM ({REPORT_SQL}) r, (VALUES ('history'), ('latest')) AS v(copia)",
)
def sink_dated_archive(s: Source) -> DataFrame:
    """The report, archived under its day and as the latest."""
    path = _folder(s, "arquivo")
    report = kpi.report_summary(*daily.counted_bases(s.tables, RUN_DATE, FLOOR), window())
    sinks.write_archive(report, path, window()[1])
    copies = [
        s.spark.read.parquet(f"{path}/{copy}").select(F.lit(copy).alias("copia"), *report.columns)
        for copy in ("history", "latest")
    ]
    return union_by_name(copies)


@query(
    "export_single_snapshot",
    """SELECT upper(placa) AS placa, chassi, reg_id AS matricula, unidade,
    set_status AS status_conjunto, cliente, start_day AS inicio_vig, act_day AS data_ativacao,
    empresa FROM (
        SELECT *, row_number() OVER (PARTITION BY chassi ORDER BY start_day DESC, reg_ts DESC,
            CASE empresa WHEN 'Segtruck' THEN 1 WHEN 'Stcoop' THEN 2 WHEN 'Viavante' THEN 3
            ELSE 4 END, set_id DESC, cov_id, bri_id, plate_id) AS r FROM chain_ok
        WHERE sid = 7 AND ben_status = 'ATIVO' AND CAST(reg_ts AS DATE) <= DATE '2001-07-30')
    WHERE r = 1""",
)
def export_single_snapshot(s: Source) -> DataFrame:
    """The active base of the last snapshot day as CSV."""
    path = _folder(s, "export")
    rows = backfill.active_on_day(s.snapshots, S.SNAPSHOT_END)
    rows = rows.withColumn("placa", F.upper("placa"))
    sinks.write_detail(rows, path, "csv")
    return s.spark.read.schema(rows.schema).option("header", True).csv(path)
