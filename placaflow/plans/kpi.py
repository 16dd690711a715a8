"""Daily KPIs, the summary report and the history rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as RunningOrder
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placaflow import config as C
from placaflow.functions import calendar as K
from placaflow.functions import expressions as X
from placaflow.functions import predicates as P
from placaflow.operators.aggregates import count_where, with_total
from placaflow.operators.joins import BRAND, zero_fill
from placaflow.operators.sets import constant_rows, union_by_name

Window = tuple[dt.date, dt.date]


def brand_spine(spark: SparkSession) -> DataFrame:
    """The fixed brands, upper-cased as in the detail bases, in report order."""
    rows = [(brand.rank, brand.label.upper()) for brand in C.BRANDS]
    schema = T.StructType(
        [T.StructField("ordem", T.IntegerType()), T.StructField(BRAND, T.StringType())]
    )
    return constant_rows(spark, schema, rows)


def _in(column: str, window: Window) -> Column:
    return P.period_mask(F.col(column), *window)


def daily_kpis(active: DataFrame, cancellations: DataFrame, window: Window) -> DataFrame:
    """Per brand: activated, finalised, cancelled, benefits cancelled. Always 4 rows."""
    kind, status = F.col("identificador"), F.col("status")
    activated = active.where(_in("inicio_vig", window)).groupBy(BRAND).agg(
        F.count("*").alias("ativados")
    )
    ended = cancellations.where(_in("data_cancelamento", window)).groupBy(BRAND).agg(
        *count_where(
            {
                "finalizados": P.is_full_with_status(kind, status, C.FINALISED),
                "cancelados": P.is_full_with_status(kind, status, C.CANCELLED),
                "beneficios_cancelados": P.is_partial(kind),
            }
        )
    )
    spine = brand_spine(active.sparkSession)
    return zero_fill(zero_fill(spine, activated, [BRAND]), ended, [BRAND])


def period_totals(active: DataFrame, cancellations: DataFrame, window: Window) -> DataFrame:
    """All activations and all cancellations of the period, whatever their status."""
    activated = active.agg(*count_where({"total_ativados": _in("inicio_vig", window)}))
    ended = cancellations.agg(*count_where({"total_cancelados": _in("data_cancelamento", window)}))
    return _one_row(activated, ended)


def _one_row(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row frames side by side (sums over a null-padded union)."""
    union = union_by_name(frames, allow_missing=True)
    return union.agg(*[F.sum(c).alias(c) for c in union.columns])


def first_start_per_chassis(active: DataFrame, column: str = "inicio_vig") -> DataFrame:
    """A chassis is active as of d when its earliest start is <= d."""
    return active.groupBy("chassi").agg(F.min(column).alias("inicio"))


def active_as_of(
    active: DataFrame, days: Iterable[dt.date], column: str = "inicio_vig"
) -> DataFrame:
    """Distinct chassis active as of each day: how many began on a day, summed up to each day.

    The plan is the same for one day and for many. Chassis are counted by their first day before
    anything is summed, so the running sum has at most a row for each day of the calendar.
    """
    days = sorted(set(days))
    began = first_start_per_chassis(active, column).where("inicio IS NOT NULL")
    began = began.groupBy(F.col("inicio").cast("date").alias("data")).agg(F.count("*").alias("n"))
    asked = K.days_of(active.sparkSession, days, "data")
    both = asked.withColumn("n", F.lit(0)).withColumn("asked", F.lit(True)).unionByName(
        began.withColumn("asked", F.lit(False))
    )
    upto = RunningOrder.orderBy("data").rangeBetween(RunningOrder.unboundedPreceding, RunningOrder.currentRow)
    totals = both.withColumn("qtd_ativos", F.sum("n").over(upto)).where("asked")
    return totals.select("data", F.col("qtd_ativos").cast("long").alias("qtd_ativos"))


def per_day_counts(active: DataFrame, cancellations: DataFrame, window: Window) -> DataFrame:
    """Activations and cancellations of each day of the window, 0 where none."""
    spine = K.date_spine(active.sparkSession, *window, name="data")
    activated = (
        active.where(_in("inicio_vig", window))
        .groupBy(F.col("inicio_vig").alias("data"))
        .agg(F.count("*").alias("ativados"))
    )
    ended = (
        cancellations.where(_in("data_cancelamento", window))
        .groupBy(F.col("data_cancelamento").alias("data"))
        .agg(F.count("*").alias("cancelados"))
    )
    return zero_fill(zero_fill(spine, activated, ["data"]), ended, ["data"])


def daily_history(
    active: DataFrame,
    cancellations: DataFrame,
    window: Window,
    active_column: str = "inicio_vig",
) -> DataFrame:
    """History rows: per day the active total, activations and cancellations.

    On Mondays three rows (Friday, Saturday, Sunday), else one.
    """
    totals = active_as_of(active, K.days_between(*window), active_column)
    counts = per_day_counts(active, cancellations, window)
    return totals.join(counts, "data").orderBy("data")


def marked_history(history: DataFrame) -> DataFrame:
    """Older history rows: a weekend day shows its name in place of the active total."""
    return history.select(
        "data", X.weekend_marker(F.col("data"), F.col("qtd_ativos")).alias("qtd_ativos")
    )


def report_summary(active: DataFrame, cancellations: DataFrame, window: Window) -> DataFrame:
    """The report: four brands and their total, the period and the active total."""
    kpis = daily_kpis(active, cancellations, window)
    measures = ["ativados", "finalizados", "cancelados", "beneficios_cancelados"]
    table = with_total(kpis.select(BRAND, *measures), BRAND)
    header = active_as_of(active, [window[1]]).select(
        X.thousands_ptbr(F.col("qtd_ativos")).alias("total_ativos")
    )
    period = X.period_label(F.lit(window[0]), F.lit(window[1]))
    rank = F.expr(f"coalesce({X.brand_rank()}, {len(C.BRANDS) + 1})")
    return table.select(
        rank.alias("ordem"),
        BRAND,
        *measures,
        period.alias("periodo"),
        header.scalar().alias("total_ativos"),
    ).orderBy("ordem")


def simple_brand_totals(active: DataFrame, cancellations: DataFrame, window: Window) -> DataFrame:
    """Older report: activations and cancellations per brand, without the kind split."""
    activated = active.where(_in("inicio_vig", window)).groupBy(BRAND).agg(
        F.count("*").alias("ativados")
    )
    ended = cancellations.where(_in("data_cancelamento", window)).groupBy(BRAND).agg(
        F.count("*").alias("cancelados")
    )
    spine = brand_spine(active.sparkSession)
    filled = zero_fill(zero_fill(spine, activated, [BRAND]), ended, [BRAND])
    return with_total(filled.select(BRAND, "ativados", "cancelados"), BRAND)


def cancelled_plates_of_day(full: DataFrame, day: dt.date) -> DataFrame:
    """Distinct plates of full cancellations on one day."""
    of_day = full.where(P.period_mask(F.col("data_cancelamento"), day, day))
    return of_day.select("placa").distinct()
