"""Choices per chassis, exclusions and the overdue list on hand-written rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import Fixture, ticks
from placaflow import config as C
from placaflow.plans import backfill, detail, kpi
from placaflow.schemas import INVOICES_SCHEMA

RUN = dt.date(2025, 6, 2)


def active(fixture: Fixture, **options):
    events = detail.plate_events(fixture.tables(), [C.ACTIVE], with_names=False)
    return detail.active_plates(events, RUN, **options).collect()


def consolidated(fixture: Fixture, **options):
    events = detail.plate_events(fixture.tables(), with_names=False)
    return detail.consolidated_cancellations(events, RUN, **options).collect()


def test_two_benefits_of_one_set_lowest_coverage_wins(fixture):
    fixture.contract(1, id_status=2, date_cancellation="2025-05-01")
    fixture.vehicle(5).cover(12, 1, id_vehicle=5).cover(11, 1, id_vehicle=5)
    rows = consolidated(fixture)
    assert [r.coverage_id for r in rows] == [11]


def test_later_registration_wins_across_brands(fixture):
    for set_id, brand, day in ((1, "Segtruck", "2025-01-01"), (2, "Tag", "2025-02-01")):
        fixture.contract(set_id, brand, data_registration=day).vehicle(5, brand)
        fixture.cover(set_id, set_id, brand, id_vehicle=5)
    assert [r.empresa for r in active(fixture)] == ["TAG"]


def test_equal_registration_takes_the_brand_order(fixture):
    for set_id, brand in ((1, "Tag"), (2, "Viavante"), (3, "Stcoop")):
        fixture.contract(set_id, brand).vehicle(5, brand).cover(set_id, set_id, brand, id_vehicle=5)
    assert [r.empresa for r in active(fixture)] == ["STCOOP"]


def test_active_choice_comes_before_upper_casing(fixture):
    fixture.contract(1).vehicle(5, chassi="abc").cover(1, 1, id_vehicle=5)
    fixture.contract(2).vehicle(6, chassi="ABC").cover(2, 2, id_vehicle=6)
    assert [r.chassi for r in active(fixture)] == ["ABC", "ABC"]


def test_prefer_effective_start(fixture):
    fixture.contract(1, "Segtruck", data_registration="2025-05-01", date_inital_effect="2025-01-01")
    fixture.contract(2, "Tag", data_registration="2025-04-01", date_inital_effect="2025-02-01")
    for set_id, brand in ((1, "Segtruck"), (2, "Tag")):
        fixture.vehicle(5, brand).cover(set_id, set_id, brand, id_vehicle=5)
    assert [r.empresa for r in active(fixture)] == ["SEGTRUCK"]
    assert [r.empresa for r in active(fixture, prefer="effective_start")] == ["TAG"]


def test_floor_applies_after_the_choice(fixture):
    fixture.vehicle(5)
    fixture.contract(1, id_status=2, data_registration="2023-01-01", date_cancellation="2025-05-01")
    fixture.contract(2, id_status=2, data_registration="2024-01-01", date_cancellation="2024-12-31")
    fixture.cover(1, 1, id_vehicle=5).cover(2, 2, id_vehicle=5)
    assert consolidated(fixture) == []


def test_status_without_description_is_not_closed(fixture):
    fixture.vehicle(5).contract(1, id_status=9, date_cancellation="2025-05-01")
    fixture.cover(1, 1, id_vehicle=5)
    events = detail.plate_events(fixture.tables(), [C.FULL], with_names=False)
    assert detail.full_cancellations(events, RUN).count() == 0
    events = detail.plate_events(fixture.tables(), [C.FULL], closed_only=False, with_names=False)
    assert detail.full_cancellations(events, RUN).count() == 1


def test_partial_of_a_chassis_active_in_other_letter_case_is_dropped(fixture):
    fixture.contract(1).vehicle(5, chassi="xyz").cover(1, 1, id_vehicle=5)
    fixture.contract(2, "Tag").vehicle(6, "Tag", chassi="XYZ")
    fixture.cover(2, 2, "Tag", id_vehicle=6, id_status=2)
    assert consolidated(fixture) == []
    assert [r.identificador for r in consolidated(fixture, exclude_active=False)] == ["PARCIAL"]


def test_full_wins_over_partial_on_one_day(fixture):
    fixture.vehicle(5)
    fixture.contract(1, id_status=2, date_cancellation="2025-04-01T15:00:00")
    fixture.cover(1, 1, id_vehicle=5)
    fixture.contract(2).cover(2, 2, id_vehicle=5, id_status=3, updated_at=ticks("2025-04-01T09:00:00"))
    rows = consolidated(fixture)
    assert [(r.identificador, r.data_cancelamento) for r in rows] == [
        ("INTEGRAL", dt.date(2025, 4, 1))
    ]


def test_vehicle_without_board_takes_the_trailer_board_and_keeps_its_chassis(fixture):
    fixture.contract(1).vehicle(5, board=None).trailer(9).cover(1, 1, id_vehicle=5)
    fixture.add("insurance_reg_set_cov_trailer", parent=1, id_trailer=9)
    (row,) = active(fixture)
    assert (row.placa, row.chassi, row.id_placa, row.id_carroceria) == ("TRB", "CH1", 5, 9)


def test_direct_trailer_comes_last_and_plate_is_required(fixture):
    fixture.contract(1).trailer(9).cover(1, 1, id_trailer=9)
    fixture.contract(2).vehicle(6, board=None, chassi="NOBOARD").cover(2, 2, id_vehicle=6)
    assert [(r.placa, r.id_veiculo) for r in active(fixture)] == [("TRB", None)]


def test_start_date_fallback_and_null_dates(fixture):
    fixture.vehicle(5, chassi="A").vehicle(6, chassi="B")
    fixture.contract(1, date_inital_effect=None, date_final_effect="2026-01-01")
    fixture.contract(2, date_inital_effect=None)
    fixture.cover(1, 1, id_vehicle=5).cover(2, 2, id_vehicle=6)
    starts = {r.chassi: r.inicio_vig for r in active(fixture)}
    assert starts == {"A": dt.date(2025, 1, 2), "B": None}
    events = detail.plate_events(fixture.tables(), with_names=False)
    rows = detail.active_plates(events, RUN)
    assert rows.count() == 2
    assert kpi.active_as_of(rows, [RUN]).first().qtd_ativos == 1


def test_repeated_lookup_rows_do_not_multiply_plates(fixture):
    fixture.contract(1, id_unity=3).vehicle(5).cover(1, 1, id_vehicle=5)
    fixture.add("representante", codigo=3, cnpj_cpf="R3")
    fixture.add("catalogo", cnpj_cpf="R3", fantasia="b").add("catalogo", cnpj_cpf="R3", fantasia="a")
    events = detail.plate_events(fixture.tables(), [C.ACTIVE])
    assert [r.unidade for r in detail.active_plates(events, RUN).collect()] == ["A"]


def test_brand_of_a_lookup_is_respected(fixture):
    fixture.contract(1, "Tag").cover(1, 1, "Tag", id_vehicle=5)
    fixture.vehicle(5, "Segtruck", board="WRONG").vehicle(5, "Tag", board="RIGHT")
    assert [r.placa for r in active(fixture)] == ["RIGHT"]


def test_older_report_leaves_partials_undated(fixture):
    fixture.vehicle(5).contract(1).cover(1, 1, id_vehicle=5, id_status=2)
    rows = detail.all_cancellations(
        fixture.tables(), RUN, exclude_active=False, with_names=False, date_partials=False
    )
    assert [(r.identificador, r.data_cancelamento) for r in rows.collect()] == [("PARCIAL", None)]


def bills(spark, rows):
    return spark.createDataFrame(rows, INVOICES_SCHEMA)


def test_paid_and_null_pointers(spark):
    rows = [
        (1, 1, 10, 1, "Tag", "a"), (1, 2, 10, 1, "Tag", "a"),   # paid: removed
        (None, 1, 11, 1, "Tag", "a"), (None, 2, 11, 1, "Tag", "a"),  # null pointer paid: removed
        (2, 1, 12, 1, "Tag", "a"), (2, 1, 12, 1, "Tag", "a"),   # open, repeated: one row
        (3, None, 13, 1, "Tag", "a"),                           # unknown history: not open
    ]
    kept = detail.delinquent_sets(bills(spark, rows)).collect()
    assert [r.conjunto for r in kept] == [12]


def test_null_pointer_that_is_only_open_stays(spark):
    kept = detail.delinquent_sets(bills(spark, [(None, 1, 11, 1, "Tag", "a")])).collect()
    assert [r.conjunto for r in kept] == [11]


def test_member_rules(spark):
    rows = [
        (1, 1, 1, 1, "Stcoop", None), (2, 1, 2, 1, "Tag", None),
        (3, 1, 3, 1, "Tag", "TESTE A"), (4, 1, 4, 1, "Tag", "teste a"),
        (5, 1, 5, 1, "Segtruck", C.EXCLUDED_ASSOCIATION), (6, 1, 6, 1, "Tag", C.EXCLUDED_ASSOCIATION),
    ]
    kept = detail.delinquent_sets(bills(spark, rows)).collect()
    assert sorted(r.conjunto for r in kept) == [2, 4, 6]


def test_overdue_flag_and_channel(fixture, spark):
    for n, unit in ((1, None), (2, "xmfx"), (3, "Outro")):
        fixture.contract(n, id_unity=n, id_status=2, date_cancellation="2025-05-01")
        fixture.vehicle(n, chassi=f"C{n}").cover(n, n, id_vehicle=n)
        fixture.add("representante", codigo=n, cnpj_cpf=f"R{n}")
        fixture.add("catalogo", cnpj_cpf=f"R{n}", fantasia=unit)
    events = detail.plate_events(fixture.tables())
    overdue = bills(spark, [(1, 1, 2, 1, "Tag", "a")])
    rows = detail.consolidated_cancellations(events, RUN, overdue).orderBy("chassi").collect()
    assert [r.categoria_comercial for r in rows] == [
        C.PARTNER_CATEGORY, C.FRANCHISE_CATEGORY, C.PARTNER_CATEGORY,
    ]
    assert [r.inadimplente_45 for r in rows] == ["NÃO", "SIM", "NÃO"]


# Snapshots ---------------------------------------------------------------------------


def snapshots(fixture: Fixture) -> Fixture:
    """Two days (Mon 2 June and Wed 4 June 2025); the day between has no snapshot."""
    for day in ("2025-06-02", "2025-06-04"):
        fixture.contract(1, day=day, date_inital_effect="2025-05-31")
        fixture.cover(1, 1, day=day, id_vehicle=5).vehicle(5, day=day)
    # no chassis at all, twice, on the first day
    fixture.contract(2, day="2025-06-02", date_inital_effect="2025-06-01")
    fixture.cover(2, 2, day="2025-06-02").cover(3, 2, day="2025-06-02")
    return fixture


SPAN = (dt.date(2025, 6, 2), dt.date(2025, 6, 4))


def test_missing_day_is_zero_and_marked(dated_fixture):
    rows = backfill.backfill_active(snapshots(dated_fixture).tables(), *SPAN, C.BRANDS[:1])
    assert [tuple(r) for r in rows.orderBy("data").collect()] == [
        (dt.date(2025, 6, 2), 1, True, 0),
        (dt.date(2025, 6, 3), 0, False, 3),
        (dt.date(2025, 6, 4), 1, True, 0),
    ]


def test_null_chassis_counts_once_among_the_activated(dated_fixture):
    rows = backfill.backfill_activated(snapshots(dated_fixture).tables(), *SPAN)
    counts = {r.data: r.total_ativados for r in rows.collect()}
    # Monday reports Friday to Sunday: the plate of 31 May and one null chassis
    assert counts[dt.date(2025, 6, 2)] == 2
    assert counts[dt.date(2025, 6, 4)] == 0
    # Friday alone (30 May) has neither
    friday = backfill.backfill_activated(dated_fixture.tables(), *SPAN, mode="friday_only")
    assert {r.total_ativados for r in friday.collect()} == {0}


def test_cancelled_set_without_coverage_counts(dated_fixture):
    for n in (1, 2):
        dated_fixture.contract(
            n, day="2025-06-04", id_status=8, date_final_effect="2025-06-03"
        )
    rows = backfill.backfill_cancelled(dated_fixture.tables(), *SPAN).collect()
    assert {r.data.day: r.total_cancelados for r in rows} == {2: 0, 3: 0, 4: 1}


def test_one_job_equals_single_days(spark):
    from placaflow.standin import tables as S

    sf = "/root/testdata/sf0.001"
    frames = S.snapshot_tables(spark, sf)
    together = backfill.backfill_active(frames, S.SNAPSHOT_START, S.SNAPSHOT_END)
    counts = {r.data: r.ativos for r in together.collect()}
    for day in (S.SNAPSHOT_START, S.SNAPSHOT_END):
        (alone,) = backfill.backfill_active(frames, day, day).collect()
        assert alone.ativos == counts[day]
        assert backfill.active_on_day(frames, day).agg(F.count("*")).first()[0] == counts[day]


def test_a_coverage_without_id_keeps_its_plate(fixture):
    """Also one whose id could not be read: it is null then."""
    fixture.vehicle(5).contract(1).cover(None, 1, id_vehicle=5)
    events = detail.plate_events(fixture.tables(), [C.ACTIVE], with_names=False)
    rows = detail.active_plates(events, dt.date(2025, 6, 2)).collect()
    assert [r.chassi for r in rows] == ["CH1"]


def test_order_of_active_plates(fixture):
    """Latest start first, ties by set, no start last."""
    for n, start in ((1, "2025-03-01"), (2, "2025-04-01"), (3, "2025-03-01"), (4, None)):
        fixture.vehicle(n, chassi=f"C{n}").contract(n, date_inital_effect=start)
        fixture.cover(n, n, id_vehicle=n)
    events = detail.plate_events(fixture.tables(), [C.ACTIVE], with_names=False)
    rows = detail.active_plates(events, dt.date(2025, 6, 2)).collect()
    assert [r.chassi for r in rows] == ["C2", "C1", "C3", "C4"]
