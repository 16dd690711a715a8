"""Unions, and small constant frames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_by_name(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames (duplicates kept), columns matched by name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), list(frames)
    )


def constant_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[tuple]) -> DataFrame:
    """Rows written in the program, as literals of the plan.

    Unlike a frame made from a Python list, Spark knows how small it is: joins with it
    need no shuffle, and filters on it are evaluated while planning.
    """
    if not rows:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return spark.sql("SELECT 1 AS nothing WHERE false").select(*nothing)
    cells = {f"r{r}c{c}": v for r, row in enumerate(rows) for c, v in enumerate(row)}
    marks = ", ".join(
        "(" + ", ".join(f":r{r}c{c}" for c in range(len(row))) + ")" for r, row in enumerate(rows)
    )
    names = ", ".join(f"`{name}`" for name in schema.fieldNames())
    values = spark.sql(f"SELECT * FROM VALUES {marks} AS t({names})", args=cells)
    return values.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
