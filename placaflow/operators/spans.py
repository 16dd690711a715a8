"""Daily snapshots as spans: one row for as long as nothing in it changes.

Days are numbered in the order in which they landed; a day that did not land has no number and
ends no span. A row that is there on the last day has an open end. Snapshots repeat nearly all
rows of the day before, so the spans of 200 days are little more than one day's rows, and what
is joined and counted over them grows with the changes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placaflow.operators.dedupe import keep_first
from placaflow.operators.joins import DAY, OPEN, SPAN
from placaflow.operators.ordering import OrderSpec
from placaflow.operators.sets import constant_rows, union_by_name

FIRST, LAST = SPAN
_NUMBER = "dia"
_BITS = 62


def spans_of(df: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Snapshot rows of the landed `days` as spans; equal rows of several days become one.

    Rows of a single day are taken as they are, without a shuffle.
    """
    columns = [c for c in df.columns if c != DAY]
    if len(days) == 1:
        ends = {FIRST: F.lit(0), LAST: F.lit(OPEN)}
        return df.where(F.col(DAY) == F.lit(days[0])).select(*columns).withColumns(ends)
    number = (F.array_position(F.array(*[F.lit(d) for d in days]), F.col(DAY)) - 1).cast("int")
    numbered = df.where(F.col(DAY).isin(list(days))).select(*columns, number.alias(_NUMBER)) if days else None
    if numbered is None:
        return df.select(*columns, *[F.lit(0).alias(c) for c in SPAN]).where("false")
    # The days of a row as bits of a few numbers: they combine before the shuffle.
    words = range(-(-len(days) // _BITS))
    bits = [f"bit_or(if({_NUMBER} div {_BITS} = {w}, shiftleft(1L, {_NUMBER} % {_BITS}), 0L)) AS _w{w}" for w in words]
    packed = numbered.groupBy(*columns).agg(F.min(_NUMBER).alias("_a"), F.max(_NUMBER).alias("_b"), *map(F.expr, bits))
    held = " + ".join(f"bit_count(_w{w})" for w in words)
    word = f"element_at(array({', '.join(f'_w{w}' for w in words)}), CAST(d div {_BITS} + 1 AS INT))"
    own = f"filter(sequence(_a, _b), d -> shiftright({word}, d % {_BITS}) & 1L = 1L)"
    firsts = "filter(own, (d, i) -> i = 0 OR own[i - 1] < d - 1)"
    lasts = "filter(own, (d, i) -> i = size(own) - 1 OR own[i + 1] > d + 1)"
    runs = f"transform(array({own}), own -> zip_with({firsts}, {lasts}, (a, b) -> struct(a AS a, b AS b)))[0]"
    whole = f"if({held} = _b - _a + 1, array(struct(_a AS a, _b AS b)), {runs})"
    runs = packed.select(*columns, F.explode(F.expr(whole)).alias("_run"))
    end = f"if(_run.b = {len(days) - 1}, {OPEN}, _run.b)"
    return runs.select(*columns, F.col("_run.a").alias(FIRST), F.expr(end).alias(LAST))


def extend_spans(spans: DataFrame, snapshot: DataFrame, number: int) -> DataFrame:
    """The spans after one more landed day, whose rows are `snapshot` (without a day column).

    Only rows that were still there meet the day's rows; closed spans are carried on as they are.
    """
    columns = [c for c in spans.columns if c not in SPAN]
    still = spans.where(F.col(LAST) == OPEN).select(*columns, FIRST, F.lit(False).alias("_now"))
    today = snapshot.select(*columns, F.lit(None).cast("int").alias(FIRST), F.lit(True).alias("_now"))
    met = still.unionByName(today).groupBy(*columns).agg(F.min(FIRST).alias(FIRST), F.max("_now").alias("_now"))
    end = F.when(F.col("_now"), OPEN).otherwise(number - 1)
    met = met.select(*columns, F.coalesce(FIRST, F.lit(number)).alias(FIRST), end.alias(LAST))
    return union_by_name([spans.where(F.col(LAST) < OPEN), met])


def first_by_day(df: DataFrame, keys: Iterable[str], order: OrderSpec, days: int) -> DataFrame:
    """Per key and day the first row in `order`, as spans.

    Keys with one row keep its span. Others are told apart day by day; before that, one row per
    key and span is left, so that a key has at most as many rows as there are pairs of days.
    """
    keys = list(keys)
    best = keep_first(df, [*keys, *SPAN], order)
    counted = best.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    single = counted.where("_n = 1").drop("_n")
    each = F.explode(F.sequence(F.col(FIRST), F.least(F.col(LAST), F.lit(days - 1))))
    several = counted.where("_n > 1").drop("_n").withColumn(_NUMBER, each).drop(*SPAN)
    several = keep_first(several, [*keys, _NUMBER], order)
    same = {FIRST: F.col(_NUMBER), LAST: F.col(_NUMBER)}
    return single.unionByName(several.withColumns(same).drop(_NUMBER))


def count_distinct_by_day(df: DataFrame, key: str, days: Sequence[dt.date], out: str) -> DataFrame:
    """How many keys are there on each day (null counts as one): `landing_date` and the count.

    A row adds the days that no earlier row of its key had: +1 on the first, -1 after the last.
    """
    pieces = df.select(key, *SPAN).distinct()
    before = F.max(LAST).over(Window.partitionBy(key).orderBy(*SPAN).rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.withColumn(FIRST, F.greatest(F.col(FIRST), before + 1)).where(F.col(FIRST) <= F.col(LAST))
    steps = F.array(F.struct(F.col(FIRST).alias("n"), F.lit(1).alias("d")), F.struct((F.col(LAST) + 1).alias("n"), F.lit(-1).alias("d")))
    changes = pieces.select(F.inline(steps)).groupBy("n").agg(F.sum("d").alias("d"))
    return running_total(changes, days, out)


def running_total(changes: DataFrame, days: Sequence[dt.date], out: str) -> DataFrame:
    """Sums of the changes (n, d) up to each day; days that no change reaches have 0."""
    spine = day_numbers(changes.sparkSession, days)
    filled = spine.join(changes, F.col(_NUMBER) == F.col("n"), "left")
    upto = Window.orderBy(_NUMBER).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per day
    return filled.select(DAY, F.coalesce(F.sum("d").over(upto), F.lit(0)).alias(out))


def day_numbers(spark, days: Sequence[dt.date]) -> DataFrame:
    schema = T.StructType([T.StructField(_NUMBER, T.IntegerType()), T.StructField(DAY, T.DateType())])
    return constant_rows(spark, schema, list(enumerate(days)))


def count_latest_within(df: DataFrame, key: str, date: str, windows: Sequence[tuple[dt.date, dt.date, dt.date]], out: str) -> DataFrame:
    """Per day, how many keys (null is one) have their latest date of that day in the day's window.

    `windows`: landed day, first and last date. That is so where some row's date of the day lies
    in the window and none after it; both are asked for rows with a date in a window only.
    """
    spark = df.sparkSession
    rows = df.groupBy(F.col(key).alias("_key"), *SPAN).agg(F.max(date).alias("_date")).where("_date IS NOT NULL")
    names = [_NUMBER, DAY, "_from", "_to"]
    kinds = [T.IntegerType(), T.DateType(), T.DateType(), T.DateType()]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    spine = constant_rows(spark, schema, [(n, *w) for n, w in enumerate(windows)])
    dates = spine.where("_from <= _to").withColumn("_date", F.explode(F.sequence("_from", "_to")))
    there = F.col(_NUMBER).between(F.col(FIRST), F.col(LAST))
    inside = rows.join(dates, "_date").where(there).select("_key", _NUMBER, DAY, "_to").distinct()
    later = rows.select(F.col("_key").alias("_other"), "_date", *SPAN)
    after = F.col("_key").eqNullSafe(F.col("_other")) & there & (F.col("_date") > F.col("_to"))
    counted = inside.join(later, after, "left_anti").groupBy(DAY).agg(F.count("*").alias(out))
    return spine.select(DAY).join(counted, DAY, "left").select(DAY, F.coalesce(out, F.lit(0)).alias(out))
