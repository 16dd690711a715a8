"""Test data -> source tables, by fixed formulas (FIXTURES.md §2).

Tables without a brand column are shared by all brands. Nothing is written: the
reports run on these frames as they would on scanned tables.
"""

from __future__ import annotations

import datetime as dt
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placaflow import config as C
from placaflow.functions.calendar import date_spine
from placaflow.operators.joins import BRAND, DAY
from placaflow.operators.sets import constant_rows
from placaflow.schemas import SOURCE_SCHEMAS
from placaflow.sources.lazy import LazyTables
from placaflow.sources.manifest import TABLE

# Status rows of the stand-in.
STATUSES = ((7, "ATIVO"), (2, "CANCELADO"), (3, "FINALIZADO"), (4, "RENOVACAO"), (5, "NAO RENOVADO"))
TICKS_PER_HOUR = 36000000000

SNAPSHOT_START = dt.date(2001, 7, 20)
SNAPSHOT_END = dt.date(2001, 7, 30)
MISSING_SNAPSHOT = dt.date(2001, 7, 25)


# Columns of the test data that the formulas read.
RAW_SCHEMAS = {
    "customer": "c_custkey long, c_name string, c_nationkey int",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_size int",
    "supplier": "s_suppkey long, s_name string",
}

COVERAGE_ID = "((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _brand(set_id: str) -> str:
    *first, last = C.BRANDS
    cases = " ".join(f"WHEN {n} THEN '{b.label}'" for n, b in enumerate(first))
    return f"CASE {set_id} % {len(C.BRANDS)} {cases} ELSE '{last.label}' END AS {BRAND}"


def insurance_reg_set(orders: DataFrame, customer: DataFrame) -> DataFrame:
    joined = orders.join(
        customer.select("c_custkey", "c_nationkey"), F.expr("o_custkey = c_custkey"), "left"
    )
    ended = "o_orderstatus IN ('F', 'P')"
    return joined.selectExpr(
        "o_orderkey AS id",
        "o_custkey AS parent",
        """CASE o_orderstatus WHEN 'O' THEN 7L WHEN 'P' THEN 4L
            ELSE if(o_orderkey % 2 = 0, 2L, 3L) END AS id_status""",
        "CAST(c_nationkey AS BIGINT) AS id_unity",
        "o_custkey % 10 AS id_consultant",
        "if(o_orderkey % 3 = 0, NULL, o_custkey % 7) AS id_user_support",
        "if(o_orderkey % 7 = 0, o_orderkey - 4, NULL) AS id_renovated_set",
        "o_orderdate AS data_registration",
        "if(o_orderkey % 5 = 0, NULL, o_orderdate) AS date_inital_effect",
        "o_orderdate + INTERVAL 360 DAYS AS date_final_effect",
        "o_orderdate + INTERVAL 1 DAY AS date_activation",
        f"if({ended}, o_orderdate + INTERVAL 30 DAYS, NULL) AS date_cancellation",
        f"if({ended}, 'User ' || o_orderkey % 7, NULL) AS user_name_cancellation",
        _brand("o_orderkey"),
    )


def insurance_reg_set_coverage(lineitem: DataFrame) -> DataFrame:
    no_dates = "l_linenumber % 4 = 0"
    days = "CAST(datediff(l_shipdate, DATE'1900-01-01') AS BIGINT)"
    return lineitem.selectExpr(
        f"{COVERAGE_ID} AS id",
        "l_orderkey AS parent",
        "if(l_linenumber % 3 = 0, l_partkey, NULL) AS id_vehicle",
        "if(l_linenumber % 3 = 1, l_suppkey, NULL) AS id_trailer",
        """CASE l_returnflag WHEN 'N' THEN 7L WHEN 'R' THEN 2L
            ELSE if(l_partkey % 2 = 0, 3L, 5L) END AS id_status""",
        "l_partkey AS id_price_list",
        f"{C.TICKS_AT_1900} + {days} * {C.TICKS_PER_DAY} + l_partkey % 24 * {TICKS_PER_HOUR}"
        " AS updated_at",
        f"if({no_dates}, NULL, l_shipdate) AS date_initial_effect",
        f"if({no_dates}, NULL, l_shipdate + INTERVAL 360 DAYS) AS date_final_effect",
        _brand("l_orderkey"),
    )


def insurance_reg_set_cov_trailer(lineitem: DataFrame) -> DataFrame:
    return lineitem.where("l_linenumber % 3 = 2 OR l_linenumber = 6").selectExpr(
        f"{COVERAGE_ID} AS parent", "l_suppkey AS id_trailer", _brand("l_orderkey")
    )


def catalogo(customer: DataFrame, nation: DataFrame) -> DataFrame:
    people = customer.selectExpr(
        "'C' || c_custkey AS cnpj_cpf", "c_name AS nome", "CAST(NULL AS STRING) AS fantasia"
    )
    units = nation.selectExpr(
        "'R' || n_nationkey AS cnpj_cpf",
        """CASE n_regionkey WHEN 2 THEN 'FTR ' || n_name WHEN 3 THEN 'Digital ' || n_name
            ELSE n_name END AS nome""",
        """CASE n_regionkey WHEN 0 THEN 'Unidade ' || n_name
            WHEN 1 THEN 'Franqueado ' || n_name ELSE n_name END AS fantasia""",
    )
    return people.unionByName(units)


def source_tables(spark: SparkSession, sf_dir: str) -> LazyTables:
    """All source tables, each derived when first used."""

    @cache
    def raw(name: str) -> DataFrame:
        return read(spark, sf_dir, name)

    def derived(name: str, *columns: str, distinct: bool = False):
        def opened() -> DataFrame:
            df = raw(name).selectExpr(*columns)
            return df.distinct() if distinct else df

        return opened

    users = [(n, f"User {n}") for n in range(7)]
    kind = "CAST(p_size % 6 AS BIGINT)"
    return LazyTables(
        {
            "insurance_registration": derived(
                "customer", "c_custkey AS id", "c_custkey AS customer_id"
            ),
            "insurance_reg_set": lambda: insurance_reg_set(raw("orders"), raw("customer")),
            "insurance_reg_set_coverage": lambda: insurance_reg_set_coverage(raw("lineitem")),
            "insurance_reg_set_cov_trailer": lambda: insurance_reg_set_cov_trailer(
                raw("lineitem")
            ),
            "insurance_vehicle": derived(
                "part",
                "p_partkey AS id",
                "if(p_partkey % 17 = 0, NULL, 'plt' || p_partkey) AS board",
                "'chs' || p_partkey AS chassi",
            ),
            "insurance_trailer": derived(
                "supplier",
                "s_suppkey AS id",
                "'trp' || s_suppkey AS board",
                "'trl' || s_suppkey AS chassi",
            ),
            "insurance_status": lambda: constant_rows(
                spark, SOURCE_SCHEMAS["insurance_status"], STATUSES
            ),
            "cliente": derived("customer", "c_custkey AS codigo", "'C' || c_custkey AS cnpj_cpf"),
            "catalogo": lambda: catalogo(raw("customer"), raw("nation")),
            "representante": derived(
                "nation",
                "CAST(n_nationkey AS BIGINT) AS codigo",
                "'R' || n_nationkey AS cnpj_cpf",
            ),
            "vendedor": derived("supplier", "s_suppkey AS codigo", "s_name AS descricao"),
            "price_list_benefits": derived(
                "part", "p_partkey AS id", "CAST(p_size AS BIGINT) AS id_type_category"
            ),
            "type_category": derived(
                "part", "CAST(p_size AS BIGINT) AS id", f"{kind} AS id_category", distinct=True
            ),
            "category": derived("part", f"{kind} AS id", f"{kind} AS id_benefits", distinct=True),
            "benefits": derived(
                "part", f"{kind} AS id", "'Beneficio ' || p_size % 6 AS description", distinct=True
            ),
            "web_user": lambda: constant_rows(spark, SOURCE_SCHEMAS["web_user"], users),
        }
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = read(spark, sf_dir, "orders").join(
        customer, F.expr("o_custkey = c_custkey"), "left"
    )
    return joined.selectExpr(
        "o_orderkey div 2 AS ponteiro",
        "if(o_orderkey % 5 = 0, 2, 1) AS historico",
        "o_orderkey AS conjunto",
        "o_custkey AS matricula",
        _brand("o_orderkey"),
        "if(o_custkey % 50 = 0, 'TESTE ' || c_name, c_name) AS associado",
    )


def snapshot_tables(
    spark: SparkSession,
    sf_dir: str,
    start: dt.date = SNAPSHOT_START,
    end: dt.date = SNAPSHOT_END,
    missing: dt.date = MISSING_SNAPSHOT,
) -> LazyTables:
    """Daily snapshots: the sets registered up to each day, all coverages every day.

    Plates and lookups are the same on every day and carry no day column.
    """
    tables = source_tables(spark, sf_dir)

    def dated(name: str, first: Column) -> DataFrame:
        days = F.sequence(F.greatest(first, F.lit(start)), F.lit(end))
        # a sequence that starts after its end would count down: such rows have no day
        return (
            tables[name]
            .where(first <= F.lit(end))
            .withColumn(DAY, F.explode(days))
            .where(F.col(DAY) != F.lit(missing))
        )

    def opened(name: str) -> DataFrame:
        if name == "insurance_reg_set":
            return dated(name, F.col("data_registration").cast("date"))
        if name in ("insurance_reg_set_coverage", "insurance_reg_set_cov_trailer"):
            return dated(name, F.lit(start))
        return tables[name]

    def manifest() -> DataFrame:
        """Every brand lands every table every day but the missing one."""
        spine = date_spine(spark, start, end, DAY).where(F.col(DAY) != F.lit(missing))
        labels = F.array(*[F.lit(brand.label) for brand in C.BRANDS])
        names = F.array(*[F.lit(name) for name in tables])
        rows = spine.select(DAY, F.explode(labels).alias(BRAND)).select("*", F.explode(names).alias(TABLE))
        return rows.withColumns({"files": F.lit(1), "bytes": F.lit(1)})

    return LazyTables({name: partial(opened, name) for name in tables}, manifest)
