"""SQL twins of the stand-in tables and of the shared bases, for an ANSI SQL engine.

Written apart from the Spark code, from the driver's raw tables: every choice is made
in the plain two-step way (rank per brand, then across brands) and every lookup is a
left join, so that the Spark plans' shortcuts are checked rather than repeated.
"""

from __future__ import annotations

import re

FLOOR = "DATE '1998-01-01'"
MONDAY = "DATE '2001-07-30'"
FRIDAY = "DATE '2001-07-27'"
SUNDAY = "DATE '2001-07-29'"


def brand_of(key: str) -> str:
    return (
        f"CASE {key} % 4 WHEN 0 THEN 'Segtruck' WHEN 1 THEN 'Stcoop' "
        "WHEN 2 THEN 'Viavante' ELSE 'Tag' END"
    )


def brand_no(column: str) -> str:
    return (
        f"CASE upper({column}) WHEN 'SEGTRUCK' THEN 1 WHEN 'STCOOP' THEN 2 "
        "WHEN 'VIAVANTE' THEN 3 ELSE 4 END"
    )


TICK_DAY = (
    "(TIMESTAMP '1900-01-01 00:00:00' + "
    "to_days(CAST((ticks - 599266080000000000) // 864000000000 AS INTEGER)))"
)
COVERAGE_KEY = "((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey"

CTES: dict[str, str] = {
    "statuses": """SELECT * FROM (VALUES (7, 'ATIVO'), (2, 'CANCELADO'), (3, 'FINALIZADO'),
        (4, 'RENOVACAO'), (5, 'NAO RENOVADO')) AS t(sid, txt)""",
    "sets": f"""SELECT o_orderkey AS set_id, o_custkey AS reg_id, {brand_of('o_orderkey')} AS empresa,
        CASE WHEN o_orderstatus = 'O' THEN 7 WHEN o_orderstatus = 'P' THEN 4
             WHEN o_orderkey % 2 = 0 THEN 2 ELSE 3 END AS sid,
        c_nationkey AS unit_id, o_custkey % 10 AS seller_id,
        CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 7 END AS helper_id,
        CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey - 4 END AS renewed,
        o_orderdate AS reg_ts,
        CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS eff_from,
        o_orderdate + INTERVAL 360 DAY AS eff_to,
        o_orderdate + INTERVAL 1 DAY AS act_ts,
        CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate + INTERVAL 30 DAY END AS cancel_ts,
        CASE WHEN o_orderstatus IN ('F', 'P')
             THEN 'User ' || CAST(o_orderkey % 7 AS VARCHAR) END AS canceller
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "covers": f"""SELECT {COVERAGE_KEY} AS cov_id, l_orderkey AS set_id,
        {brand_of('l_orderkey')} AS empresa,
        CASE WHEN l_linenumber % 3 = 0 THEN l_partkey END AS veh_id,
        CASE WHEN l_linenumber % 3 = 1 THEN l_suppkey END AS dir_id,
        CASE WHEN l_returnflag = 'N' THEN 7 WHEN l_returnflag = 'R' THEN 2
             WHEN l_partkey % 2 = 0 THEN 3 ELSE 5 END AS sid,
        l_partkey AS price_id,
        599266080000000000
          + CAST(date_diff('day', DATE '1900-01-01', CAST(l_shipdate AS DATE)) AS BIGINT)
            * 864000000000
          + (l_partkey % 24) * 36000000000 AS ticks,
        CASE WHEN l_linenumber % 4 <> 0 THEN l_shipdate END AS eff_from,
        CASE WHEN l_linenumber % 4 <> 0 THEN l_shipdate + INTERVAL 360 DAY END AS eff_to
        FROM lineitem""",
    "bridge": f"""SELECT {COVERAGE_KEY} AS cov_id, {brand_of('l_orderkey')} AS empresa,
        l_suppkey AS bri_id FROM lineitem WHERE l_linenumber % 3 = 2 OR l_linenumber = 6""",
    "vehicles": """SELECT p_partkey AS id, 'chs' || CAST(p_partkey AS VARCHAR) AS chassi,
        CASE WHEN p_partkey % 17 <> 0 THEN 'plt' || CAST(p_partkey AS VARCHAR) END AS board
        FROM part""",
    "trailers": """SELECT s_suppkey AS id, 'trl' || CAST(s_suppkey AS VARCHAR) AS chassi,
        'trp' || CAST(s_suppkey AS VARCHAR) AS board FROM supplier""",
    "units": """SELECT n_nationkey AS unit_id, 'R' || CAST(n_nationkey AS VARCHAR) AS doc,
        CASE n_regionkey WHEN 2 THEN 'FTR ' || n_name WHEN 3 THEN 'Digital ' || n_name
             ELSE n_name END AS nome,
        CASE n_regionkey WHEN 0 THEN 'Unidade ' || n_name WHEN 1 THEN 'Franqueado ' || n_name
             ELSE n_name END AS fantasia FROM nation""",
    "benefit_of": """SELECT p_partkey AS price_id, CAST(p_size % 6 AS BIGINT) AS benefit_id,
        'Beneficio ' || CAST(p_size % 6 AS VARCHAR) AS beneficio FROM part""",
    "contracts": """SELECT s.*, st.txt AS set_status, c.c_name AS cliente, u.fantasia AS unidade,
        u.nome AS unit_nome, sel.s_name AS consultor,
        CASE WHEN s.helper_id IS NOT NULL
             THEN 'User ' || CAST(s.helper_id AS VARCHAR) END AS usuario_suporte,
        CAST(coalesce(s.eff_from, s.eff_to - INTERVAL 364 DAY) AS DATE) AS start_day,
        CAST(s.act_ts AS DATE) AS act_day, CAST(s.cancel_ts AS DATE) AS cancel_day
        FROM sets s LEFT JOIN statuses st ON st.sid = s.sid
        LEFT JOIN customer c ON c.c_custkey = s.reg_id
        LEFT JOIN units u ON u.unit_id = s.unit_id
        LEFT JOIN supplier sel ON sel.s_suppkey = s.seller_id""",
    "plates": f"""SELECT k.cov_id, k.set_id, k.empresa, k.veh_id, g.bri_id, k.dir_id, k.ticks,
        {TICK_DAY} AS tick_ts, ks.txt AS ben_status, bo.beneficio,
        CAST(coalesce(k.eff_from, k.eff_to - INTERVAL 364 DAY) AS DATE) AS ben_start,
        coalesce(v.board, b.board, d.board) AS placa,
        coalesce(v.chassi, b.chassi, d.chassi) AS chassi,
        coalesce(v.id, b.id, d.id) AS plate_id, coalesce(v.board, b.board) AS placa_2
        FROM covers k LEFT JOIN statuses ks ON ks.sid = k.sid
        LEFT JOIN bridge g ON g.cov_id = k.cov_id AND g.empresa = k.empresa
        LEFT JOIN vehicles v ON v.id = k.veh_id
        LEFT JOIN trailers b ON b.id = g.bri_id
        LEFT JOIN trailers d ON d.id = k.dir_id
        LEFT JOIN benefit_of bo ON bo.price_id = k.price_id""",
    "chain": """SELECT c.*, p.cov_id, p.veh_id, p.bri_id, p.dir_id, p.ticks, p.tick_ts,
        p.ben_status, p.beneficio, p.ben_start, p.placa, p.chassi, p.plate_id, p.placa_2
        FROM contracts c LEFT JOIN plates p ON p.set_id = c.set_id AND p.empresa = c.empresa""",
    "chain_ok": "SELECT * FROM chain WHERE placa IS NOT NULL AND chassi IS NOT NULL",
    "active_ranked": """SELECT *, row_number() OVER (PARTITION BY empresa, chassi
        ORDER BY reg_ts DESC, set_id DESC, cov_id, bri_id, plate_id) AS r1
        FROM chain_ok WHERE sid = 7 AND ben_status = 'ATIVO'""",
    "active_pick": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chassi
        ORDER BY reg_ts DESC, {brand_no('empresa')}) AS r2 FROM active_ranked WHERE r1 = 1)
        WHERE r2 = 1""",
    "active": f"""SELECT upper(placa) AS placa, upper(chassi) AS chassi, plate_id AS id_placa,
        veh_id AS id_veiculo, bri_id AS id_carroceria, reg_id AS matricula, set_id AS conjunto,
        renewed AS conjunto_renovado, upper(unidade) AS unidade, upper(consultor) AS consultor,
        upper(set_status) AS status_conjunto, upper(cliente) AS cliente,
        upper(usuario_suporte) AS usuario_suporte, reg_ts AS data_registro,
        start_day AS inicio_vig, act_day AS data_ativacao, {MONDAY} AS data_extracao,
        upper(empresa) AS empresa FROM active_pick""",
    "full_any": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY empresa, chassi
        ORDER BY reg_ts DESC, set_id DESC, cov_id, bri_id, plate_id) AS r1
        FROM chain_ok WHERE cancel_ts IS NOT NULL) WHERE r1 = 1""",
    "full_closed": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY empresa, chassi
        ORDER BY reg_ts DESC, set_id DESC, cov_id, bri_id, plate_id) AS r1
        FROM chain_ok WHERE cancel_ts IS NOT NULL AND set_status NOT IN ('ATIVO', 'RENOVACAO'))
        WHERE r1 = 1""",
    "partial_ended": f"""SELECT * FROM chain_ok WHERE sid = 7 AND tick_ts >= {FLOOR}
        AND ben_status IN ('CANCELADO', 'FINALIZADO', 'NAO RENOVADO')""",
    "full_closed_plain": "SELECT * EXCLUDE (r1) FROM full_closed",
    "cancel_all": f"""SELECT *, 'INTEGRAL' AS kind, cancel_day AS off_day FROM full_closed_plain
        WHERE cancel_day >= {FLOOR}
        UNION ALL SELECT *, 'PARCIAL', CAST(tick_ts AS DATE) FROM partial_ended""",
    "cancel_left": """SELECT * FROM cancel_all WHERE kind = 'INTEGRAL' OR NOT EXISTS (
        SELECT 1 FROM active_pick a WHERE upper(a.chassi) = upper(cancel_all.chassi))""",
    "cancel_pick": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY upper(chassi)
        ORDER BY off_day DESC, kind, {brand_no('empresa')}, cov_id, bri_id, plate_id) AS r3
        FROM cancel_left) WHERE r3 = 1""",
    "bills": f"""SELECT o_orderkey // 2 AS ponteiro,
        CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS historico, o_orderkey AS conjunto,
        o_custkey AS matricula, {brand_of('o_orderkey')} AS empresa,
        CASE WHEN o_custkey % 50 = 0 THEN 'TESTE ' || c_name ELSE c_name END AS associado
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "overdue": """SELECT ponteiro, historico, conjunto, matricula, empresa, associado FROM (
        SELECT *, row_number() OVER (PARTITION BY ponteiro, conjunto, matricula, empresa
            ORDER BY associado) AS rr
        FROM bills b WHERE historico = 1 AND NOT EXISTS (SELECT 1 FROM bills p
            WHERE p.historico <> 1 AND p.ponteiro IS NOT DISTINCT FROM b.ponteiro))
        WHERE rr = 1 AND NOT (empresa IN ('Viavante', 'Stcoop', 'Segtruck') AND associado =
            'APROSSIL - ASSOCIACAO DE PROPRIETARIOS DE CAMINHOES DO SUL D')
        AND coalesce(associado, '') NOT LIKE '%TESTE%'""",
    "cancelled": f"""SELECT upper(placa) AS placa, upper(chassi) AS chassi, plate_id AS id_placa,
        veh_id AS id_veiculo, bri_id AS id_carroceria, reg_id AS matricula, set_id AS conjunto,
        upper(unidade) AS unidade, upper(consultor) AS consultor, upper(set_status) AS status,
        upper(cliente) AS cliente, upper(usuario_suporte) AS usuario_suporte,
        upper(canceller) AS usuario_cancelamento, cov_id AS coverage_id,
        upper(beneficio) AS beneficio, upper(ben_status) AS status_beneficio,
        {MONDAY} AS data_extracao, reg_ts AS data_registro, start_day AS data_ativacao,
        ben_start AS data_ativacao_beneficio, off_day AS data_cancelamento,
        upper(empresa) AS empresa, kind AS identificador,
        CASE WHEN regexp_matches(coalesce(unidade, ''),
             'UNIDADE|MF|FRANQUEADO|MICRO|TS CONSULTORIA|TRANSDESK DIGITAL', 'i')
             THEN 'UNIDADES/FRANQUIAS' ELSE 'PARCEIROS/CORRETORES/FTR' END AS categoria_comercial,
        CASE WHEN set_id IN (SELECT conjunto FROM overdue) THEN 'SIM' ELSE 'NÃO' END
             AS inadimplente_45 FROM cancel_pick""",
    "brands": """SELECT * FROM (VALUES (1, 'SEGTRUCK'), (2, 'STCOOP'), (3, 'VIAVANTE'), (4, 'TAG'))
        AS t(ordem, empresa)""",
    "snap_days": """SELECT CAST(d AS DATE) AS day FROM generate_series(TIMESTAMP '2001-07-20',
        TIMESTAMP '2001-07-30', INTERVAL 1 DAY) AS g(d)""",
    "snaps": "SELECT day FROM snap_days WHERE day <> DATE '2001-07-25'",
    "snap_windows": """SELECT day, CASE WHEN isodow(day) = 1 THEN day - 3 ELSE day - 1 END AS w0,
        day - 1 AS w1 FROM snap_days""",
}


def with_tables(body: str) -> str:
    """The body under a WITH list of exactly the bases it uses."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.append(name)
                visit(definition)

    visit(body)
    listed = [n for n in CTES if n in needed]
    if not listed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in listed) + "\n" + body
