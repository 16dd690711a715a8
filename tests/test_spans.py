"""Snapshots as spans: the same rows and counts as day by day."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from placaflow import config as C
from placaflow.operators import joins, spans
from placaflow.plans import backfill

DAYS = [dt.date(2025, 5, 29) + dt.timedelta(days=n) for n in range(7)]  # Thursday to Wednesday
LANDED = [d for d in DAYS if d.day != 31]


def snapshots(spark, seed, rows=40, keys=8):
    rng = random.Random(seed)
    held = [(d, "Tag", rng.randrange(keys), rng.choice([None, "a", "b"])) for d in LANDED for _ in range(rows) if rng.random() < 0.6]
    return spark.createDataFrame(held, "landing_date date, empresa string, k int, v string")


def by_day(df, columns):
    """Rows of spans, day by day, each once."""
    return sorted(
        {(d, *[r[c] for c in columns]) for r in df.collect() for n, d in enumerate(LANDED) if r.dia_de <= n <= r.dia_ate}, key=str
    )


@pytest.mark.parametrize("many", [0, 130])
def test_spans_hold_the_rows_of_each_day(spark, many):
    """Also with more days than one number has bits."""
    days = [LANDED[0] - dt.timedelta(days=n) for n in range(many, 0, -1)] + LANDED
    df = snapshots(spark, 1)
    df = df.unionByName(spark.createDataFrame([(d, "Tag", 99, "x") for d in days if d.day % 3], df.schema))
    found = spans.spans_of(df, days).collect()
    held = {(days[n], r.k, r.v) for r in found for n in range(r.dia_de, min(r.dia_ate, len(days) - 1) + 1)}
    assert held == {(r.landing_date, r.k, r.v) for r in df.collect()}
    cells = [(r.k, r.v, n) for r in found for n in range(r.dia_de, min(r.dia_ate, len(days) - 1) + 1)]
    assert len(cells) == len(set(cells))
    assert {r.dia_ate for r in found if r.dia_ate >= len(days) - 1} == {joins.OPEN}


def test_spans_grow_day_by_day(spark):
    df = snapshots(spark, 2)
    grown = spans.spans_of(df, LANDED[:1])
    for n, day in enumerate(LANDED[1:], 1):
        grown = spans.extend_spans(grown, df.where(F.col("landing_date") == F.lit(day)).drop("landing_date"), n)
    columns = ["empresa", "k", "v", "dia_de", "dia_ate"]
    whole = spans.spans_of(df, LANDED).select(*columns).collect()
    assert sorted(map(str, grown.select(*columns).collect())) == sorted(map(str, whole))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_over_spans(spark, how):
    a, b = snapshots(spark, 3), snapshots(spark, 4, rows=6, keys=12)
    left, right = spans.spans_of(a, LANDED), spans.spans_of(b, LANDED)
    found = joins.lookup(left, right, {"k": "k"}, {"v": "w"}, how)
    plain = joins.lookup(a, b, {"k": "k"}, {"v": "w"}, how)
    columns = ["empresa", "k", "v", "w"]
    assert by_day(found, columns) == sorted({(r.landing_date, *[r[c] for c in columns]) for r in plain.collect()}, key=str)


def test_anti_join_over_spans(spark):
    a, b = snapshots(spark, 5), snapshots(spark, 6, rows=5, keys=12)
    found = joins.exclude_keys(spans.spans_of(a, LANDED), spans.spans_of(b, LANDED), ["k", "dia_de", "dia_ate", "empresa"])
    plain = joins.exclude_keys(a, b, ["k", "landing_date", "empresa"])
    columns = ["empresa", "k", "v"]
    assert by_day(found, columns) == sorted({(r.landing_date, *[r[c] for c in columns]) for r in plain.collect()}, key=str)


def test_choice_and_counts_over_spans(spark):
    df = snapshots(spark, 7)
    held = spans.spans_of(df, LANDED)
    first = spans.first_by_day(held, ["k"], [("v", "desc")], len(LANDED))
    rows = df.collect()
    best = {}
    for r in sorted(rows, key=lambda r: r.v or ""):
        best[r.landing_date, r.k] = r.v
    assert by_day(first, ["k", "v"]) == sorted({(d, k, v) for (d, k), v in best.items()}, key=str)
    counts = spans.count_distinct_by_day(held, "v", LANDED, "n").collect()
    assert {r.landing_date: r.n for r in counts} == {d: len({r.v for r in rows if r.landing_date == d}) for d in LANDED}


def changing(fixture):
    """Contracts, plates, names and statuses that come, change and go from day to day."""
    rng = random.Random(11)
    for day in map(str, LANDED):
        for brand in ("Segtruck", "Tag"):
            for v in range(5):
                if rng.random() < 0.8:
                    chassi = rng.choice(["CH1", "CH2", "ch2", None, f"X{v}"])
                    fixture.vehicle(v, brand, rng.choice(["AAA1", None]), chassi, day)
            for t in range(3):
                if rng.random() < 0.7:
                    fixture.trailer(t, brand, chassi=rng.choice(["TR1", "CH1"]), day=day)
            for s in range(6):
                if rng.random() < 0.85:
                    fixture.contract(
                        s, brand, day, id_status=rng.choice([7, 7, 2, 8]), date_inital_effect=rng.choice(["2025-05-30", "2025-06-01", "2025-06-02"]),
                        date_final_effect=rng.choice([None, "2025-06-01", "2025-06-02"]), data_registration=rng.choice(["2025-03-01", "2025-04-01"]),
                        date_cancellation=rng.choice([None, "2024-05-05", "2025-06-01"]), id_unity=s % 2,
                    )
            for c in range(9):
                if rng.random() < 0.8:
                    fixture.cover(
                        c, c % 5, brand, day, id_vehicle=rng.choice([None, 0, 1, 2, 3, 4]), id_trailer=rng.choice([None, 1]),
                        id_status=rng.choice([7, 7, 2, 3]),
                    )
                if rng.random() < 0.3:
                    fixture.add("insurance_reg_set_cov_trailer", brand, day, parent=c, id_trailer=rng.randrange(3))
            for u in range(2):
                fixture.add("representante", brand, day, codigo=u, cnpj_cpf=f"R{u}")
        for u in range(2):
            if rng.random() < 0.8:
                fixture.add("catalogo", None, day, cnpj_cpf=f"R{u}", nome="n", fantasia=rng.choice(["Loja", "Outra"]))
    for name in ("catalogo",):
        for brand in ("Segtruck", "Tag"):
            fixture.rows[name] += [{**r, "empresa": brand} for r in fixture.rows[name] if r["empresa"] is None]
        fixture.rows[name] = [r for r in fixture.rows[name] if r["empresa"] is not None]
    return fixture.tables()


def test_many_days_equal_single_days(dated_fixture):
    tables = changing(dated_fixture)
    reports = {
        "ativos": lambda a, b: backfill.backfill_active(tables, a, b),
        "ativados_unidade": lambda a, b: backfill.backfill_activated(tables, a, b, units=["Loja"]),
        "cancelados": lambda a, b: backfill.backfill_cancelled(tables, a, b),
        "cancelamentos": lambda a, b: backfill.backfill_cancellations(tables, a, b, C.DATE_FLOOR),
    }
    for name, report in reports.items():
        together = {r.data: tuple(r)[1] for r in report(DAYS[0], DAYS[-1]).collect()}
        for day in (DAYS[3], DAYS[4]):  # a Sunday, and a Monday that reports three days
            assert tuple(report(day, day).first())[1] == together[day], name
        assert any(together.values()), name
