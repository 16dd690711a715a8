"""Single operators as named queries, each over whole tables of the test data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placaflow import config as C
from placaflow.functions import calendar as K
from placaflow.functions import expressions as X
from placaflow.functions import predicates as P
from placaflow.operators import aggregates as A
from placaflow.operators import joins as J
from placaflow.operators.dedupe import keep_first
from placaflow.operators.ordering import order_by_rank, order_rows, top_k
from placaflow.operators.sets import union_by_name
from placaflow.plans import base, detail, rankings
from placaflow.standin.registry import FLOOR, RUN_DATE, Source, query
from placaflow.standin.reports import cancelled

BRAND = J.BRAND
_ALL_TIME = (FLOOR, dt.date(2100, 1, 1))
_AFTER = dt.date(2001, 1, 1)
_AFTER_SQL = "DATE '2001-01-01'"


def _sets(s: Source) -> DataFrame:
    return s.tables["insurance_reg_set"]


def _covers(s: Source) -> DataFrame:
    return s.tables["insurance_reg_set_coverage"]


def _catalogue(s: Source) -> DataFrame:
    return s.tables["catalogo"]


def _sets_with_status(s: Source) -> DataFrame:
    rows = _sets(s).withColumnRenamed("id", "conjunto")
    return base.status_lookup(rows, s.tables, "id_status", {"description": "status"})


def _covers_with_status(s: Source) -> DataFrame:
    rows = _covers(s).withColumnRenamed("id", "coverage_id")
    return base.status_lookup(rows, s.tables, "id_status", {"description": "status"})


# Projections -------------------------------------------------------------------------


def _references(s: Source) -> DataFrame:
    """Coverages with their plate references, sets not needed."""
    rows = _covers(s).select(
        BRAND,
        F.col("id").alias("coverage_id"),
        F.col("parent").alias("conjunto"),
        F.col("id_vehicle").alias("id_veiculo"),
        F.col("id_trailer").alias("id_reboque"),
    )
    return base.bridged_trailers(rows, s.tables)


@query(
    "plate_identity",
    """SELECT cov_id AS coverage_id, bri_id AS id_carroceria, placa, chassi, plate_id AS
    id_placa FROM plates""",
)
def plate_identity(s: Source) -> DataFrame:
    rows = base.vehicle_or_trailer(_references(s), s.tables)
    return rows.select("coverage_id", "id_carroceria", "placa", "chassi", "id_placa")


@query("identity_two_way", "SELECT cov_id AS coverage_id, placa_2 AS placa FROM plates")
def identity_two_way(s: Source) -> DataFrame:
    rows = base.vehicle_or_trailer(_references(s), s.tables, ["board"], direct=False)
    return rows.select("coverage_id", "placa")


@query(
    "passthrough_coalesce",
    """SELECT cov_id AS coverage_id, coalesce(veh_id) AS id_veiculo, coalesce(bri_id) AS
    id_carroceria FROM plates""",
)
def passthrough_coalesce(s: Source) -> DataFrame:
    return _references(s).select("coverage_id", "id_veiculo", "id_carroceria")


@query(
    "effective_start",
    """SELECT set_id AS conjunto, CAST(coalesce(eff_from, eff_to - INTERVAL 364 DAY) AS DATE)
    AS inicio_vig FROM sets""",
)
def effective_start(s: Source) -> DataFrame:
    start = X.effective_start(F.col("date_inital_effect"), F.col("date_final_effect"))
    return _sets(s).select(F.col("id").alias("conjunto"), start.alias("inicio_vig"))


@query(
    "ticks_to_timestamp",
    """SELECT cov_id AS coverage_id, tick_ts AS data_atualizacao
    FROM plates""",
)
def ticks_to_timestamp(s: Source) -> DataFrame:
    day = X.ticks_to_timestamp(F.col("updated_at"))
    return _covers(s).select(F.col("id").alias("coverage_id"), day.alias("data_atualizacao"))


@query(
    "benefit_effective_start",
    "SELECT cov_id AS coverage_id, ben_start AS data_ativacao_beneficio FROM plates",
)
def benefit_effective_start(s: Source) -> DataFrame:
    start = X.effective_start(F.col("date_initial_effect"), F.col("date_final_effect"))
    return _covers(s).select(
        F.col("id").alias("coverage_id"), start.alias("data_ativacao_beneficio")
    )


@query(
    "to_date_cast",
    """SELECT set_id AS conjunto, CAST(act_ts AS DATE) AS data_ativacao,
    CAST(cancel_ts AS DATE) AS data_cancelamento FROM sets""",
)
def to_date_cast(s: Source) -> DataFrame:
    return _sets(s).select(
        F.col("id").alias("conjunto"),
        F.col("date_activation").cast("date").alias("data_ativacao"),
        F.col("date_cancellation").cast("date").alias("data_cancelamento"),
    )


@query("extraction_date", "SELECT set_id AS conjunto, DATE '2001-07-30' AS data_extracao FROM sets")
def extraction_date(s: Source) -> DataFrame:
    return _sets(s).select(F.col("id").alias("conjunto"), F.lit(RUN_DATE).alias("data_extracao"))


@query("brand_literal", "SELECT id, empresa FROM vehicles, (SELECT DISTINCT empresa FROM sets)")
def brand_literal(s: Source) -> DataFrame:
    vehicles = s.tables["insurance_vehicle"]
    return union_by_name(
        vehicles.select("id", F.lit(brand.label).alias(BRAND)) for brand in C.BRANDS
    )


@query("rename_column", "SELECT cov_id AS coverage_id, tick_ts AS data_cancelamento FROM plates")
def rename_column(s: Source) -> DataFrame:
    return ticks_to_timestamp(s).withColumnRenamed("data_atualizacao", "data_cancelamento")


@query("drop_if_exists", "SELECT set_id AS conjunto, empresa FROM sets")
def drop_if_exists(s: Source) -> DataFrame:
    """A rank column goes where it is there (first branch) and is no error where it is not."""
    rows = _sets(s).select(F.col("id").alias("conjunto"), BRAND)
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy("conjunto").orderBy(BRAND)))
    return ranked.where("rn = 1").drop("rn").drop("rn")


@query(
    "constant_tag",
    """SELECT set_id AS chave, 'INTEGRAL' AS identificador FROM sets
    UNION ALL SELECT cov_id, 'PARCIAL' FROM covers""",
)
def constant_tag(s: Source) -> DataFrame:
    return union_by_name(
        [
            _sets(s).select(F.col("id").alias("chave"), F.lit(C.FULL).alias("identificador")),
            _covers(s).select(F.col("id").alias("chave"), F.lit(C.PARTIAL).alias("identificador")),
        ]
    )


_CATALOGUE_SQL = """(SELECT 'C' || CAST(c_custkey AS VARCHAR) AS cnpj_cpf, c_name AS nome,
    CAST(NULL AS VARCHAR) AS fantasia FROM customer UNION ALL SELECT doc, nome, fantasia FROM units)"""


@query(
    "upper_all_strings",
    f"""SELECT upper(cnpj_cpf) AS cnpj_cpf, upper(nome) AS nome, upper(fantasia) AS fantasia
    FROM {_CATALOGUE_SQL}""",
)
def upper_all_strings(s: Source) -> DataFrame:
    return X.upper_all_strings(_catalogue(s))


@query("upper_expr", f"SELECT cnpj_cpf, upper(fantasia) AS unidade FROM {_CATALOGUE_SQL}")
def upper_expr(s: Source) -> DataFrame:
    return _catalogue(s).select("cnpj_cpf", F.upper("fantasia").alias("unidade"))


@query(
    "unit_display_name",
    f"""SELECT cnpj_cpf, CASE WHEN nome LIKE '%FTR%' THEN nome ELSE fantasia END AS unidade
    FROM {_CATALOGUE_SQL}""",
)
def unit_display_name(s: Source) -> DataFrame:
    name = X.unit_display_name(F.col("nome"), F.col("fantasia"))
    return _catalogue(s).select("cnpj_cpf", name.alias("unidade"))


@query(
    "commercial_category",
    f"""SELECT cnpj_cpf, CASE WHEN coalesce(regexp_matches(fantasia,
    'UNIDADE|MF|FRANQUEADO|MICRO|TS CONSULTORIA|TRANSDESK DIGITAL', 'i'), false)
    THEN 'UNIDADES/FRANQUIAS' ELSE 'PARCEIROS/CORRETORES/FTR' END AS categoria_comercial
    FROM {_CATALOGUE_SQL}""",
)
def commercial_category(s: Source) -> DataFrame:
    return _catalogue(s).select(
        "cnpj_cpf", X.commercial_category(F.col("fantasia")).alias("categoria_comercial")
    )


@query(
    "flag_to_label",
    """SELECT set_id AS conjunto, CASE WHEN set_id % 5 = 0 THEN 'SIM' ELSE 'NÃO' END AS aberto
    FROM sets""",
)
def flag_to_label(s: Source) -> DataFrame:
    no_start = F.col("date_inital_effect").isNull()
    return _sets(s).select(F.col("id").alias("conjunto"), X.flag_to_label(no_start).alias("aberto"))


@query(
    "lenient_date",
    """SELECT set_id AS conjunto, CASE WHEN set_id % 13 <> 0 THEN CAST(reg_ts AS DATE) END AS data
    FROM sets""",
)
def lenient_date(s: Source) -> DataFrame:
    text = F.when(F.col("id") % 13 == 0, "sem data").otherwise(
        F.col("data_registration").cast("string")
    )
    return _sets(s).select(F.col("id").alias("conjunto"), X.lenient_date(text).alias("data"))


@query(
    "typed_null_fill",
    """SELECT set_id AS conjunto, coalesce(helper_id, 0) AS id_user_support,
    coalesce(canceller, 'N/A') AS usuario_cancelamento,
    coalesce(CAST(CAST(cancel_ts AS DATE) AS VARCHAR), 'N/A') AS data_cancelamento,
    eff_from AS inicio FROM sets""",
)
def typed_null_fill(s: Source) -> DataFrame:
    rows = _sets(s).select(
        F.col("id").alias("conjunto"),
        "id_user_support",
        F.col("user_name_cancellation").alias("usuario_cancelamento"),
        F.col("date_cancellation").cast("date").alias("data_cancelamento"),
        F.col("date_inital_effect").alias("inicio"),
    )
    return X.typed_null_fill(rows)


@query(
    "thousands_ptbr",
    """SELECT set_id AS conjunto, replace(format('{:,}', set_id * 997), ',', '.') AS numero
    FROM sets""",
)
def thousands_ptbr(s: Source) -> DataFrame:
    return _sets(s).select(
        F.col("id").alias("conjunto"), X.thousands_ptbr(F.col("id") * 997).alias("numero")
    )


@query(
    "period_label",
    """SELECT DISTINCT d AS data, CASE WHEN isodow(d) = 1
    THEN strftime(d - 3, '%d/%m/%Y') || ' (sexta) - ' || strftime(d - 1, '%d/%m/%Y') || ' (domingo)'
    ELSE strftime(d - 1, '%d/%m/%Y') END AS periodo
    FROM (SELECT CAST(reg_ts AS DATE) AS d FROM sets)""",
)
def period_label(s: Source) -> DataFrame:
    days = _run_dates(s)
    label = X.period_label(*K.reporting_window_columns(F.col("data")))
    return days.select("data", label.alias("periodo"))


@query(
    "label_concat",
    "SELECT set_id AS conjunto, unidade || ' - ' || cliente AS rotulo FROM contracts",
)
def label_concat(s: Source) -> DataFrame:
    rows = base.unit_lookup(base.customer_lookup(_customers(s), s.tables), s.tables)
    return rows.select("conjunto", X.label_concat(F.col("unidade"), F.col("cliente")).alias("rotulo"))


@query(
    "weekend_marker",
    """SELECT d AS data, CASE isodow(d) WHEN 6 THEN 'SÁBADO' WHEN 7 THEN 'DOMINGO'
    ELSE CAST(count(*) AS VARCHAR) END AS qtd
    FROM (SELECT CAST(reg_ts AS DATE) AS d FROM sets) GROUP BY d""",
)
def weekend_marker(s: Source) -> DataFrame:
    counts = _registered_per_day(s)
    return counts.select("data", X.weekend_marker(F.col("data"), F.col("n")).alias("qtd"))


def _registered_per_day(s: Source) -> DataFrame:
    day = F.col("data_registration").cast("date").alias("data")
    return _sets(s).groupBy(day).agg(F.count("*").alias("n"))


def _run_dates(s: Source) -> DataFrame:
    return _sets(s).select(F.col("data_registration").cast("date").alias("data")).distinct()


def _customers(s: Source) -> DataFrame:
    return base.contract_sets(s.tables).withColumn("coverage_id", F.col("conjunto"))


# Filters -----------------------------------------------------------------------------


def _set_filter(name: str, sql: str, condition) -> None:
    @query(name, f"SELECT set_id AS conjunto, empresa FROM contracts WHERE {sql}")
    def filtered(s: Source) -> DataFrame:
        return _sets_with_status(s).where(condition()).select("conjunto", BRAND)


def _cover_filter(name: str, sql: str, condition) -> None:
    @query(name, f"SELECT DISTINCT cov_id AS coverage_id, empresa FROM plates WHERE {sql}")
    def filtered(s: Source) -> DataFrame:
        return _covers_with_status(s).where(condition()).select("coverage_id", BRAND)


def _bill_filter(name: str, sql: str, condition) -> None:
    @query(name, f"SELECT * FROM bills WHERE {sql}")
    def filtered(s: Source) -> DataFrame:
        return s.invoices.where(condition())


_set_filter("set_is_active", "sid = 7", lambda: P.set_is_active(F.col("id_status")))
_set_filter(
    "set_status_not_in",
    "set_status NOT IN ('ATIVO', 'RENOVACAO')",
    lambda: P.set_status_not_in(F.col("status")),
)
_set_filter(
    "set_status_equals",
    "set_status IN ('CANCELADO', 'CANCELADO_PARCIAL')",
    lambda: P.set_status_equals(F.col("status")),
)
_set_filter(
    "cancel_date_not_null",
    "cancel_ts IS NOT NULL",
    lambda: P.cancel_date_not_null(F.col("date_cancellation")),
)
_set_filter(
    "exact_cancel_date",
    "cancel_day = DATE '2001-07-27'",
    lambda: P.exact_date(F.col("date_cancellation"), dt.date(2001, 7, 27)),
)
_set_filter(
    "as_of_mask",
    f"start_day <= {_AFTER_SQL}",
    lambda: P.as_of_mask(
        X.effective_start(F.col("date_inital_effect"), F.col("date_final_effect")), _AFTER
    ),
)
_set_filter(
    "period_mask",
    "act_day BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'",
    lambda: P.period_mask(
        F.col("date_activation").cast("date"), dt.date(2001, 7, 1), dt.date(2001, 7, 31)
    ),
)
_set_filter(
    "days_mask",
    "act_day IN (DATE '2001-07-27', DATE '2001-07-28', DATE '2001-07-29')",
    lambda: P.days_mask(
        F.col("date_activation").cast("date"),
        K.days_between(dt.date(2001, 7, 27), dt.date(2001, 7, 29)),
    ),
)
_cover_filter(
    "benefit_is_active", "ben_status = 'ATIVO'", lambda: P.benefit_is_active(F.col("status"))
)
_cover_filter(
    "benefit_status_in",
    "ben_status IN ('CANCELADO', 'FINALIZADO', 'NAO RENOVADO')",
    lambda: P.benefit_status_in(F.col("status")),
)
_cover_filter(
    "benefit_status_not", "ben_status <> 'ATIVO'", lambda: P.benefit_status_not(F.col("status"))
)
_cover_filter(
    "tick_floor", f"tick_ts >= {_AFTER_SQL}", lambda: P.tick_floor(F.col("updated_at"), _AFTER)
)
_bill_filter(
    "open_invoice_only", "historico = 1", lambda: P.open_invoice_only(F.col("historico"))
)
_bill_filter(
    "exclude_test_members",
    "associado NOT LIKE '%TESTE%'",
    lambda: P.exclude_test_members(F.col("associado")),
)
_bill_filter(
    "exclude_association",
    "NOT (empresa IN ('Viavante', 'Stcoop', 'Segtruck') AND associado = 'Customer#000000007')",
    lambda: P.exclude_association(F.col(BRAND), F.col("associado"), "Customer#000000007"),
)


@query(
    "identity_not_null",
    """SELECT cov_id AS coverage_id, placa, chassi
    FROM plates WHERE placa IS NOT NULL AND chassi IS NOT NULL""",
)
def identity_not_null(s: Source) -> DataFrame:
    rows = base.vehicle_or_trailer(_references(s), s.tables, ["board", "chassi"])
    rows = rows.where(P.identity_not_null(F.col("placa"), F.col("chassi")))
    return rows.select("coverage_id", "placa", "chassi")


@query(
    "date_floor_after_rank",
    f"SELECT chassi, empresa, cancel_day AS data FROM full_any WHERE cancel_day >= {_AFTER_SQL}",
)
def date_floor_after_rank(s: Source) -> DataFrame:
    events = detail.plate_events(s.tables, [C.FULL], FLOOR, closed_only=False, with_names=False)
    rows = detail.full_cancellations(events, RUN_DATE, _AFTER, upper=False)
    return rows.select("chassi", BRAND, F.col("data_cancelamento").alias("data"))


@query(
    "like_contains",
    """SELECT doc AS cnpj_cpf, nome
    FROM units WHERE upper(nome) LIKE '%DIGITAL%'""",
)
def like_contains(s: Source) -> DataFrame:
    rows = _catalogue(s).where(P.like_contains(F.upper("nome"), "DIGITAL"))
    return rows.select("cnpj_cpf", "nome")


_SOME_IDS = {"Segtruck": (1, 2), "Tag": (3,), "Viavante": (0, 5)}


@query(
    "id_in_per_brand",
    """SELECT set_id AS conjunto, empresa FROM sets WHERE (empresa = 'Segtruck' AND seller_id IN (1, 2))
    OR (empresa = 'Tag' AND seller_id = 3) OR (empresa = 'Viavante' AND seller_id IN (0, 5))""",
)
def id_in_per_brand(s: Source) -> DataFrame:
    rows = _sets(s).where(P.id_in_per_brand(F.col(BRAND), F.col("id_consultant"), _SOME_IDS))
    return rows.select(F.col("id").alias("conjunto"), BRAND)


@query(
    "unit_allow_list",
    """SELECT set_id AS conjunto, unidade
    FROM contracts WHERE unidade IN ('Unidade NATION_5', 'NATION_7')""",
)
def unit_allow_list(s: Source) -> DataFrame:
    rows = base.unit_lookup(base.contract_sets(s.tables), s.tables, by=["conjunto"])
    rows = rows.where(P.unit_allow_list(F.col("unidade"), ("Unidade NATION_5", "NATION_7")))
    return rows.select("conjunto", "unidade")


@query(
    "kind_and_status_masks",
    f"""SELECT upper(chassi) AS chassi, kind AS identificador, CASE WHEN kind = 'PARCIAL' THEN 'P'
    WHEN set_status = 'CANCELADO' THEN 'C' WHEN set_status = 'FINALIZADO' THEN 'F' END AS classe
    FROM cancel_all""",
)
def kind_and_status_masks(s: Source) -> DataFrame:
    rows = detail.all_cancellations(
        s.tables, RUN_DATE, FLOOR, exclude_active=False, with_names=False
    )
    kind, status = F.col("identificador"), F.col("status")
    label = (
        F.when(P.is_partial(kind), "P")
        .when(P.is_full_with_status(kind, status, C.CANCELLED), "C")
        .when(P.is_full_with_status(kind, status, C.FINALISED), "F")
    )
    return rows.select("chassi", "identificador", label.alias("classe"))


# Joins -------------------------------------------------------------------------------


@query(
    "contract_chain",
    """SELECT c.set_id AS conjunto, r.c_custkey AS matricula, k.cov_id AS coverage_id, c.empresa
    FROM customer r LEFT JOIN sets c ON c.reg_id = r.c_custkey
    LEFT JOIN covers k ON k.set_id = c.set_id AND k.empresa = c.empresa""",
)
def contract_chain(s: Source) -> DataFrame:
    return base.contract_chain(s.tables).select("conjunto", "matricula", "coverage_id", BRAND)


@query("customer_lookup", "SELECT set_id AS conjunto, cliente FROM contracts")
def customer_lookup(s: Source) -> DataFrame:
    return base.customer_lookup(_customers(s), s.tables).select("conjunto", "cliente")


@query("unit_lookup", "SELECT set_id AS conjunto, unidade, unit_nome FROM contracts")
def unit_lookup(s: Source) -> DataFrame:
    rows = base.unit_lookup(
        _customers(s), s.tables, {"fantasia": "unidade", "nome": "unit_nome"}
    )
    return rows.select("conjunto", "unidade", "unit_nome")


@query(
    "status_lookup_two_roles",
    """SELECT c.set_id AS conjunto, p.cov_id AS coverage_id, c.set_status AS status,
    p.ben_status AS status_beneficio FROM contracts c JOIN (SELECT DISTINCT cov_id, set_id, empresa,
    ben_status FROM plates) p ON p.set_id = c.set_id AND p.empresa = c.empresa""",
)
def status_lookup_two_roles(s: Source) -> DataFrame:
    rows = base.sets_with_coverages(base.contract_sets(s.tables), base.coverages(s.tables))
    return rows.select("conjunto", "coverage_id", "status", "status_beneficio")


@query("consultant_lookup", "SELECT set_id AS conjunto, consultor FROM contracts")
def consultant_lookup(s: Source) -> DataFrame:
    return base.consultant_lookup(_customers(s), s.tables).select("conjunto", "consultor")


@query(
    "benefit_chain",
    """SELECT k.cov_id AS coverage_id, b.beneficio FROM covers k
    LEFT JOIN benefit_of b ON b.price_id = k.price_id""",
)
def benefit_chain(s: Source) -> DataFrame:
    rows = _covers(s).select(
        BRAND, F.col("id").alias("coverage_id"), F.col("parent").alias("conjunto"), "id_price_list"
    )
    return base.benefit_lookup(rows, s.tables).select("coverage_id", "beneficio")


@query(
    "support_user_subquery",
    """SELECT DISTINCT set_id AS conjunto, empresa, 'User ' || CAST(helper_id AS VARCHAR) AS suporte
    FROM sets WHERE helper_id IS NOT NULL""",
)
def support_user_subquery(s: Source) -> DataFrame:
    return base.support_users(s.tables)


@query("support_user_lookup", "SELECT set_id AS conjunto, usuario_suporte FROM contracts")
def support_user_lookup(s: Source) -> DataFrame:
    return base.support_user_lookup(_customers(s), s.tables).select("conjunto", "usuario_suporte")


@query(
    "anti_active_chassis",
    """SELECT DISTINCT upper(chassi) AS chassi FROM partial_ended
    WHERE upper(chassi) NOT IN (SELECT upper(chassi) FROM active_pick)""",
)
def anti_active_chassis(s: Source) -> DataFrame:
    events = detail.plate_events(s.tables, [C.ACTIVE, C.PARTIAL], FLOOR, with_names=False)
    ended = events.where(F.col(detail.EVENT) == C.PARTIAL)
    ended = ended.select(F.upper("chassi").alias("chassi")).distinct()
    return J.exclude_keys(ended, detail.active_chassis(events), ["chassi"])


@query(
    "anti_paid_invoices",
    """SELECT * FROM bills b WHERE NOT EXISTS (SELECT 1 FROM bills p WHERE p.historico <> 1
    AND p.ponteiro IS NOT DISTINCT FROM b.ponteiro)""",
)
def anti_paid_invoices(s: Source) -> DataFrame:
    paid = s.invoices.where(P.paid_invoice(F.col("historico"))).select("ponteiro").distinct()
    return J.exclude_keys(s.invoices, paid, ["ponteiro"], null_safe=True)


@query(
    "delinquency_membership",
    """SELECT set_id AS conjunto, set_id IN (SELECT conjunto FROM overdue) AS inadimplente
    FROM sets""",
)
def delinquency_membership(s: Source) -> DataFrame:
    rows = _sets(s).select(F.col("id").alias("conjunto"))
    return J.flag_membership(rows, detail.delinquent_sets(s.invoices), "conjunto", "inadimplente")


def _sets_per_unit(s: Source) -> DataFrame:
    return _sets(s).groupBy("id_unity").agg(F.count("*").alias("n"))


_TOP_UNITS_SQL = """(SELECT CAST(unit_id AS BIGINT) AS id_unity, count(*) AS n FROM sets
    GROUP BY 1 ORDER BY n DESC, id_unity LIMIT 4)"""


@query(
    "top_units_semi",
    f"""SELECT set_id AS conjunto FROM sets WHERE unit_id IN (SELECT id_unity
    FROM {_TOP_UNITS_SQL} t)""",
)
def top_units_semi(s: Source) -> DataFrame:
    top = top_k(_sets_per_unit(s), "id_unity", "n", 4)
    return J.keep_top(_sets(s), top, "id_unity").select(F.col("id").alias("conjunto"))


_MONTH = (dt.date(2001, 7, 15), dt.date(2001, 8, 15))


@query(
    "zero_fill_days",
    """SELECT CAST(d AS DATE) AS data, coalesce(n, 0) AS n
    FROM generate_series(TIMESTAMP '2001-07-15', TIMESTAMP '2001-08-15', INTERVAL 1 DAY) AS g(d)
    LEFT JOIN (SELECT CAST(reg_ts AS DATE) AS day, count(*) AS n FROM sets GROUP BY 1) x
    ON x.day = CAST(d AS DATE)""",
)
def zero_fill_days(s: Source) -> DataFrame:
    spine = K.date_spine(s.spark, *_MONTH, name="data")
    counts = _registered_per_day(s).where(P.period_mask(F.col("data"), *_MONTH))
    return J.zero_fill(spine, counts, ["data"])


# Aggregations, choices, orders -------------------------------------------------------


@query(
    "chassis_by_unit",
    """SELECT coalesce(unidade, 'N/A') AS unidade, count(DISTINCT chassi) AS chassis
    FROM cancelled GROUP BY 1""",
)
def chassis_by_unit(s: Source) -> DataFrame:
    return rankings.chassis_by_unit(cancelled(s), "data_cancelamento", _ALL_TIME)


_BY_CLIENT_SQL = """(SELECT coalesce(unidade, 'N/A') AS unidade, coalesce(cliente, 'N/A') AS cliente,
    count(DISTINCT chassi) AS chassis FROM cancelled GROUP BY 1, 2)"""


@query("chassis_by_unit_client", f"SELECT * FROM {_BY_CLIENT_SQL} g")
def chassis_by_unit_client(s: Source) -> DataFrame:
    return rankings.chassis_by_unit_client(cancelled(s), "data_cancelamento", _ALL_TIME)


@query(
    "unit_total_of_groups",
    f"SELECT unidade, CAST(sum(chassis) AS BIGINT) AS total FROM {_BY_CLIENT_SQL} g GROUP BY 1",
)
def unit_total_of_groups(s: Source) -> DataFrame:
    return rankings.unit_total_of_groups(chassis_by_unit_client(s))


@query(
    "report_total",
    """SELECT empresa, count(*) AS n FROM sets GROUP BY 1
    UNION ALL SELECT 'Total', count(*) FROM sets""",
)
def report_total(s: Source) -> DataFrame:
    return A.with_total(_sets(s).groupBy(BRAND).agg(F.count("*").alias("n")), BRAND)


@query(
    "select_distinct",
    """SELECT DISTINCT veh_id AS id_veiculo, dir_id AS id_reboque, empresa
    FROM covers""",
)
def select_distinct(s: Source) -> DataFrame:
    rows = _covers(s).select(
        F.col("id_vehicle").alias("id_veiculo"), F.col("id_trailer").alias("id_reboque"), BRAND
    )
    return A.distinct_values(rows, ["id_veiculo", "id_reboque", BRAND])


@query(
    "latest_registration",
    """SELECT empresa, chassi, set_id AS conjunto, cov_id AS coverage_id, reg_ts AS data_registro
    FROM active_ranked WHERE r1 = 1""",
)
def latest_registration(s: Source) -> DataFrame:
    events = detail.plate_events(s.tables, [C.ACTIVE], with_names=False)
    rows = detail.latest_registration(events)
    return rows.select(BRAND, "chassi", "conjunto", "coverage_id", "data_registro")


@query(
    "keep_first_by_key",
    """SELECT ponteiro, conjunto, matricula, empresa, associado FROM (SELECT *, row_number() OVER (
    PARTITION BY ponteiro ORDER BY associado NULLS LAST, conjunto) AS r FROM bills) WHERE r = 1""",
)
def keep_first_by_key(s: Source) -> DataFrame:
    rows = keep_first(s.invoices, ["ponteiro"], [("associado", "asc"), ("conjunto", "asc")])
    return rows.select("ponteiro", "conjunto", "matricula", BRAND, "associado")


@query(
    "order_active",
    "SELECT set_id AS conjunto, start_day AS inicio_vig, act_day AS data_ativacao FROM contracts",
)
def order_active(s: Source) -> DataFrame:
    rows = base.contract_sets(s.tables).select(
        "conjunto", "inicio_vig", F.col("ativado_em").alias("data_ativacao")
    )
    return order_rows(rows, [("inicio_vig", "desc"), ("data_ativacao", "desc"), ("conjunto", "asc")])


@query(
    "order_cancellations",
    "SELECT set_id AS conjunto, cancel_day AS data_cancelamento FROM contracts",
)
def order_cancellations(s: Source) -> DataFrame:
    rows = base.contract_sets(s.tables).select("conjunto", "data_cancelamento")
    return order_rows(rows, [("data_cancelamento", "desc"), ("conjunto", "asc")])


@query(
    "order_units",
    """SELECT unidade, empresa, count(*) AS n FROM contracts GROUP BY 1, 2""",
)
def order_units(s: Source) -> DataFrame:
    rows = base.unit_lookup(base.contract_sets(s.tables), s.tables, by=["conjunto"])
    counts = rows.groupBy("unidade", BRAND).agg(F.count("*").alias("n"))
    return order_rows(counts, [("unidade", "asc"), (BRAND, "asc")])


@query(
    "top_20_units",
    """SELECT CAST(unit_id AS BIGINT) AS id_unity, count(*) AS n FROM sets
    GROUP BY 1 ORDER BY n DESC, id_unity LIMIT 20""",
)
def top_20_units(s: Source) -> DataFrame:
    return top_k(_sets_per_unit(s), "id_unity", "n", 20)


@query("top_4_units", f"SELECT * FROM {_TOP_UNITS_SQL} t")
def top_4_units(s: Source) -> DataFrame:
    return top_k(_sets_per_unit(s), "id_unity", "n", 4)


@query(
    "order_by_unit_rank",
    f"""SELECT CAST(s.unit_id AS BIGINT) AS id_unity, s.reg_id AS matricula, count(*) AS conjuntos, t.n
    FROM sets s JOIN {_TOP_UNITS_SQL} t ON t.id_unity = s.unit_id GROUP BY 1, 2, 4""",
)
def order_by_unit_rank(s: Source) -> DataFrame:
    top = top_k(_sets_per_unit(s), "id_unity", "n", 4)
    rows = _sets(s).groupBy("id_unity", F.col("parent").alias("matricula")).agg(
        F.count("*").alias("conjuntos")
    )
    then = [("conjuntos", "desc"), ("matricula", "asc")]
    return order_by_rank(rows, top, "id_unity", "n", then)


# Unions, calendar --------------------------------------------------------------------


@query("union_brands", "SELECT set_id AS conjunto, reg_ts AS data_registro, empresa FROM sets")
def union_brands(s: Source) -> DataFrame:
    """Four single-brand frames, as separate brand tables would give them."""
    rows = _sets(s).select(
        F.col("id").alias("conjunto"), F.col("data_registration").alias("data_registro"), BRAND
    )
    return union_by_name(
        rows.where(F.col(BRAND) == b.label).drop(BRAND).withColumn(BRAND, F.lit(b.label))
        for b in C.BRANDS
    )


@query(
    "concat_by_name",
    """SELECT set_id AS chave, empresa, canceller AS usuario, CAST(NULL AS BIGINT) AS id_price_list FROM sets
    UNION ALL SELECT cov_id, empresa, NULL, price_id FROM covers""",
)
def concat_by_name(s: Source) -> DataFrame:
    return union_by_name(
        [
            _sets(s).select(
                F.col("id").alias("chave"), BRAND, F.col("user_name_cancellation").alias("usuario")
            ),
            _covers(s).select("id_price_list", BRAND, F.col("id").alias("chave")),
        ],
        allow_missing=True,
    )


def _window_sql(start: str, end: str) -> str:
    return f"""SELECT DISTINCT d AS data, {start} AS inicio, {end} AS fim
    FROM (SELECT CAST(reg_ts AS DATE) AS d FROM sets)"""


def _windows(s: Source, *mode) -> DataFrame:
    start, end = K.reporting_window_columns(F.col("data"), *mode)
    return _run_dates(s).select("data", start.alias("inicio"), end.alias("fim"))


@query(
    "reporting_window", _window_sql("CASE WHEN isodow(d) = 1 THEN d - 3 ELSE d - 1 END", "d - 1")
)
def reporting_window(s: Source) -> DataFrame:
    return _windows(s)


@query(
    "reporting_window_friday_only",
    _window_sql(
        "CASE WHEN isodow(d) = 1 THEN d - 3 ELSE d - 1 END",
        "CASE WHEN isodow(d) = 1 THEN d - 3 ELSE d - 1 END",
    ),
)
def reporting_window_friday_only(s: Source) -> DataFrame:
    return _windows(s, "friday_only")


@query("reporting_window_custom", _window_sql("d - 5", "d - 1"))
def reporting_window_custom(s: Source) -> DataFrame:
    return _windows(s, "custom", 5)


@query(
    "date_spine",
    """SELECT CAST(d AS DATE) AS data, count(c.reg_ts) AS ativos
    FROM generate_series(TIMESTAMP '2001-07-15', TIMESTAMP '2001-08-15', INTERVAL 1 DAY) AS g(d)
    LEFT JOIN sets c ON CAST(c.reg_ts AS DATE) = CAST(d AS DATE) AND c.sid = 7 GROUP BY 1""",
)
def date_spine(s: Source) -> DataFrame:
    spine = K.date_spine(s.spark, *_MONTH, name="data")
    day = F.col("data_registration").cast("date").alias("data")
    active = _sets(s).where(P.set_is_active(F.col("id_status")))
    counts = active.groupBy(day).agg(F.count("*").alias("ativos"))
    return J.zero_fill(spine, counts, ["data"])
