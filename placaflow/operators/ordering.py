"""Explicit orders and top-k."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# [(column or SQL expression, "asc" | "desc")]; nulls come last either way.
OrderSpec = Iterable[tuple[str, str]]


def order_sql(spec: OrderSpec) -> str:
    return ", ".join(f"{what} {direction.upper()} NULLS LAST" for what, direction in spec)


def order_rows(df: DataFrame, spec: OrderSpec) -> DataFrame:
    return df.orderBy(
        *[
            F.desc_nulls_last(column) if direction == "desc" else F.asc_nulls_last(column)
            for column, direction in spec
        ]
    )


def top_k(df: DataFrame, key: str, measure: str, k: int) -> DataFrame:
    """The k largest by measure, ties by key (each task keeps k rows)."""
    return order_rows(df, [(measure, "desc"), (key, "asc")]).limit(k)


def order_by_rank(
    df: DataFrame, ranked: DataFrame, key: str, measure: str, then: OrderSpec
) -> DataFrame:
    """Rows of the ranked keys, in the order of `top_k`, then by the given columns."""
    rows = df.join(ranked.select(key, measure), key)
    return order_rows(rows, [(measure, "desc"), (key, "asc"), *then])
