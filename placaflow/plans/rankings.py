"""Unit rankings of a period (the data behind the charts)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placaflow import config as C
from placaflow.functions import expressions as X
from placaflow.functions import predicates as P
from placaflow.operators.aggregates import distinct_count_by
from placaflow.operators.ordering import order_by_rank, top_k
from placaflow.operators.sets import union_by_name
from placaflow.plans.kpi import Window


def _named(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Missing names show as `N/A` before grouping, so they form a group of their own."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(C.MISSING_TEXT)) for c in columns})


def chassis_by_unit(df: DataFrame, date: str, window: Window) -> DataFrame:
    """Distinct chassis per unit in the period."""
    rows = _named(df.where(P.period_mask(F.col(date), *window)), ["unidade"])
    return distinct_count_by(rows, ["unidade"], "chassi", "chassis")


def units_ranking(
    active: DataFrame, cancellations: DataFrame, window: Window, k: int = 20
) -> DataFrame:
    """Top units by activated and by cancelled chassis."""
    activated = top_k(chassis_by_unit(active, "inicio_vig", window), "unidade", "chassis", k)
    ended = top_k(
        chassis_by_unit(cancellations, "data_cancelamento", window), "unidade", "chassis", k
    )
    return union_by_name(
        [
            activated.select(F.lit("ATIVACOES").alias("tipo"), "unidade", "chassis"),
            ended.select(F.lit("CANCELAMENTOS").alias("tipo"), "unidade", "chassis"),
        ]
    )


def chassis_by_unit_client(df: DataFrame, date: str, window: Window) -> DataFrame:
    """Distinct chassis per unit and client in the period."""
    rows = _named(df.where(P.period_mask(F.col(date), *window)), ["unidade", "cliente"])
    return distinct_count_by(rows, ["unidade", "cliente"], "chassi", "chassis")


def unit_total_of_groups(by_client: DataFrame) -> DataFrame:
    """Sum of the client counts per unit (a chassis shared by clients counts for each)."""
    return by_client.groupBy("unidade").agg(F.sum("chassis").alias("total"))


def top_units_by_client(cancellations: DataFrame, window: Window, k: int = 4) -> DataFrame:
    """Clients of the k units with most cancellations, in the order of the units."""
    by_client = chassis_by_unit_client(cancellations, "data_cancelamento", window)
    top = top_k(unit_total_of_groups(by_client), "unidade", "total", k)
    rows = by_client.withColumn("rotulo", X.label_concat(F.col("unidade"), F.col("cliente")))
    rows = order_by_rank(rows, top, "unidade", "total", [("chassis", "desc"), ("cliente", "asc")])
    return rows.select("unidade", "cliente", "chassis", "rotulo", "total")
