"""Equi-joins on scoped keys, anti-joins, existence flags, zero-filled spines.

A *scope* column says which brand and which daily snapshot a row belongs to. Joins
match on the scope columns both sides carry, so the same plan runs on one brand, on
all brands in one pass, and on all snapshot days in one pass; a table without a
scope column is shared by all brands or days.

A *span* (first and last day number, both included) may stand in place of the day: the row
then holds on each of these days. Joins match rows whose spans meet and keep the days they
share, so the same plan runs once on what changed in place of once a day (see
`operators.spans`).

No broadcast hint appears here: lookup tables grow with the data, so Spark decides
from measured sizes (threshold + AQE) and falls back to a shuffle join with skew
splitting.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = "landing_date"
BRAND = "empresa"
#: Numbers of the first and last day of a span; a span without an end ends on day `OPEN`.
SPAN = ("dia_de", "dia_ate")
OPEN = 1 << 30
_SALTS = 1 << 20


def scope_of(df: DataFrame) -> list[str]:
    """The scope columns a frame carries."""
    columns = df.columns
    return [c for c in (DAY, *SPAN, BRAND) if c in columns]


def shared_scope(left: DataFrame, right: DataFrame) -> list[str]:
    """Scope columns that are equal where rows belong together."""
    of_right = scope_of(right)
    return [c for c in scope_of(left) if c in of_right and c not in SPAN]


def has_span(*frames: DataFrame) -> bool:
    return all(SPAN[0] in df.columns for df in frames)


def span_gaps(df: DataFrame, keys: Iterable[str], span: tuple[str, str] = SPAN) -> DataFrame:
    """Per key, the spans of days on which no row has it; a key without gaps has no rows.

    A key has as many different spans as it has changes; repeated ones go before the shuffle.
    """
    first, last = span
    keys = [f"`{k}`" for k in keys]
    held = f"array_sort(collect_set(struct(`{first}` AS a, `{last}` AS b)))"
    packed = df.groupBy(*[F.col(k) for k in keys]).agg(F.expr(held).alias("_held"))
    packed = packed.where(f"NOT exists(_held, s -> s.a = 0 AND s.b = {OPEN})")
    rest = f"""aggregate(_held,
        struct(0 AS free, CAST(array() AS array<struct<a: int, b: int>>) AS gaps),
        (so, s) -> struct(greatest(so.free, s.b + 1) AS free,
            if(s.a > so.free, concat(so.gaps, array(struct(so.free AS a, s.a - 1 AS b))), so.gaps) AS gaps),
        so -> if(so.free <= {OPEN}, concat(so.gaps, array(struct(so.free AS a, {OPEN} AS b))), so.gaps))"""
    gaps = packed.select(*[F.col(k) for k in keys], F.explode(F.expr(rest)).alias("_gap"))
    return gaps.selectExpr(*keys, f"_gap.a AS `{first}`", f"_gap.b AS `{last}`")


def lookup(
    df: DataFrame,
    source: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
    spread_nulls_by: Iterable[str] = (),
) -> DataFrame:
    """Join `source` on {left column: source column} and add {source column: name}.

    `spread_nulls_by` names well distributed columns. Rows whose (single) key is null
    never match; without a spread they would all be shuffled to one task. Both sides
    get the same salt rule, so keys that are present still meet under salt 0.

    Ids come before scope columns in the join key: a sort compares the first column
    fastest, and brands or days hardly tell rows apart.
    """
    shared = shared_scope(df, source)
    pairs = [*on.items(), *[(c, c) for c in shared]]
    spans = has_span(df, source)
    held = [f"`{c}` AS _{c}" for c in SPAN] if spans else []
    right = source.selectExpr(
        *[f"`{r}` AS _key_{n}" for n, (_, r) in enumerate(pairs)],
        *[f"`{column}` AS `{name}`" for column, name in take.items()],
        *held,
    )
    if spans and how == "left":  # on days without the key its rows find nothing
        gaps = span_gaps(right, [f"_key_{n}" for n in range(len(pairs))], (f"_{SPAN[0]}", f"_{SPAN[1]}"))
        right = right.unionByName(gaps, allowMissingColumns=True)
    tests = [f"`{left}` = _key_{n}" for n, (left, _) in enumerate(pairs)]
    spread = list(spread_nulls_by)
    if spread:
        (key,) = on
        salt = f"1 + pmod(xxhash64({', '.join(spread)}), {_SALTS})"
        tests.append(f"if(`{key}` IS NULL, {salt}, 0L) = if(_key_0 IS NULL, 1L, 0L)")
    if spans:
        tests.append(f"`{SPAN[0]}` <= `_{SPAN[1]}` AND `_{SPAN[0]}` <= `{SPAN[1]}`")
    joined = df.join(right, F.expr(" AND ".join(tests)), how)
    if spans:
        first, last = (F.col(c) for c in SPAN)
        shared_days = (F.greatest(first, F.col(f"_{SPAN[0]}")), F.least(last, F.col(f"_{SPAN[1]}")))
        joined = joined.withColumns(dict(zip(SPAN, shared_days))).drop(*[f"_{c}" for c in SPAN])
    return joined.drop(*[f"_key_{n}" for n in range(len(pairs))])


def exclude_keys(
    df: DataFrame, keys: DataFrame, on: Iterable[str], null_safe: bool = False
) -> DataFrame:
    """Rows whose key does not occur in `keys` (anti-join).

    Rows with spans keep the days on which it does not.
    """
    on = list(on)
    if has_span(df, keys):
        on = [c for c in on if c not in SPAN]
        gaps = span_gaps(keys, on).withColumnsRenamed({c: f"_key_{c}" for c in on})
        gaps = gaps.withColumnsRenamed({c: f"_{c}" for c in SPAN})
        same = "<=>" if null_safe else "="
        tests = [f"`{c}` {same} `_key_{c}`" for c in on]
        tests.append(f"`{SPAN[0]}` <= `_{SPAN[1]}` AND `_{SPAN[0]}` <= `{SPAN[1]}`")
        partly = df.join(gaps, F.expr(" AND ".join(tests)))
        days = {SPAN[0]: F.greatest(SPAN[0], f"_{SPAN[0]}"), SPAN[1]: F.least(SPAN[1], f"_{SPAN[1]}")}
        partly = partly.withColumns(days).select(*df.columns)
        return exclude_keys(df, keys.select(*on), on, null_safe).unionByName(partly)
    same = "<=>" if null_safe else "="
    right = keys.selectExpr(*[f"`{c}` AS `_key_{c}`" for c in on])
    condition = " AND ".join(f"`{c}` {same} `_key_{c}`" for c in on)
    return df.join(right, F.expr(condition), "left_anti")


def flag_membership(df: DataFrame, keys: DataFrame, on: str, out: str) -> DataFrame:
    """Add a boolean: does the row's key occur in `keys`? All rows are kept."""
    right = keys.select(F.col(on).alias("_key")).where("_key is not null").distinct()
    joined = df.join(right, F.col(on) == F.col("_key"), "left")
    return joined.withColumn(out, F.col("_key").isNotNull()).drop("_key")


def keep_top(df: DataFrame, ranked: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the ranked keys."""
    return df.join(ranked.select(on), on, "left_semi")


def zero_fill(spine: DataFrame, counts: DataFrame, on: Iterable[str]) -> DataFrame:
    """Every row of the spine, with 0 where `counts` has none."""
    on = list(on)
    filled = spine.join(counts, on, "left")
    measures = [c for c in counts.columns if c not in on]
    return filled.select(
        *spine.columns, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in measures]
    )
