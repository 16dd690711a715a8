"""First row per key under a total order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from placaflow.operators.ordering import OrderSpec, order_sql


def keep_first(df: DataFrame, keys: Iterable[str], order: OrderSpec) -> DataFrame:
    """One row per key: the first in `order`. Null keys form one group.

    `row_number() = 1` lets Spark keep one candidate per key in every map task before
    the shuffle (WindowGroupLimit), so a hot key costs one row per task.
    """
    window = f"PARTITION BY {', '.join(keys)} ORDER BY {order_sql(order)}"
    ranked = df.selectExpr("*", f"row_number() OVER ({window}) AS _rn")
    return ranked.where("_rn = 1").drop("_rn")
