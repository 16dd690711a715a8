"""Counts, distinct counts and totals."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placaflow import config as C


def distinct_count_by(df: DataFrame, keys: Iterable[str], counted: str, out: str) -> DataFrame:
    """Distinct values per group (nulls not counted); duplicates go before the shuffle."""
    return df.groupBy(*keys).agg(F.countDistinct(counted).alias(out))


def distinct_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).distinct()


def count_where(conditions: Mapping[str, Column]) -> list[Column]:
    """Named conditional counts, evaluated in one pass."""
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def with_total(df: DataFrame, key: str, label: str = C.TOTAL_LABEL) -> DataFrame:
    """One row per key value plus a total row over all of them."""
    measures = [c for c in df.columns if c != key]
    rolled = df.rollup(key).agg(
        F.grouping(key).alias("_total"), *[F.sum(c).alias(c) for c in measures]
    )
    return rolled.select(
        F.when(F.col("_total") == 1, label).otherwise(F.col(key)).alias(key), *measures
    )
