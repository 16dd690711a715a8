"""What the physical plans look like, on files as a cluster would read them."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from placaflow import config as C
from placaflow.plans import backfill, detail
from placaflow.sources import scan
from placaflow.standin import tables as S

DATA = "/root/testdata/sf0.001"
FACTS = ("insurance_reg_set", "insurance_reg_set_coverage", "insurance_reg_set_cov_trailer")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The stand-in as brand folders."""
    root = str(tmp_path_factory.mktemp("landed"))
    for name, df in S.source_tables(spark, DATA).items():
        for brand in C.BRANDS:
            own = df
            if "empresa" in df.columns:
                own = df.where(df.empresa == brand.label).drop("empresa")
            own.coalesce(1).write.parquet(scan.resolve(root, brand, name))
    return root


@pytest.mark.parametrize(
    "name",
    ["active_plates", "partial_cancellations", "report_summary", "daily_history", "master_listing",
     "top_units_by_client", "cancelled_plates_by_unit", "benefit_catalogue", "backfill_cancelled",
     "delinquent_sets", "unit_search", "export_active_day"],
)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, DATA))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Cross", plan)
    assert not re.search(r"Python|ArrowEval|MapIn(Pandas|Arrow)", plan)


def test_status_filter_reaches_the_scan(spark, landed):
    events = detail.plate_events(scan.load_tables(spark, landed), [C.ACTIVE], with_names=False)
    plan = plan_of(events)
    assert plan.count("EqualTo(id_status,7)") % len(C.BRANDS) == 0 and "EqualTo(id_status,7)" in plan
    # only the columns of the chain are read from the widest table
    schemas = re.findall(r"ReadSchema: struct<([^>]*date_inital_effect[^>]*)>", plan)
    assert schemas and all("user_name_cancellation" in s or "id_unity" in s for s in schemas)
    narrow = detail.active_chassis(events)
    assert "user_name_cancellation" not in plan_of(narrow)


def test_landed_tables_give_the_same_result(spark, landed):
    from_files = scan.load_tables(spark, landed)
    derived = S.source_tables(spark, DATA)
    results = []
    for tables in (from_files, derived):
        events = detail.plate_events(tables, [C.ACTIVE])
        rows = detail.active_plates(events, S.SNAPSHOT_END)
        results.append(sorted(map(str, rows.collect())))
    assert results[0] == results[1] and results[0]


def test_one_candidate_per_key_before_each_shuffle(spark):
    plan = plan_of(entry.queries()["active_plates"](spark, DATA))
    # one choice per plate reference and one per chassis, each cut before its shuffle
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan)) == 2


def test_cuts_before_shuffle_without_broadcasts(spark):
    """With broadcasts off, null references are spread over the tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = detail.plate_events(S.source_tables(spark, DATA), [C.ACTIVE], with_names=False)
        plan = plan_of(events)
        for key in ("id_veiculo", "id_carroceria", "id_reboque"):
            assert re.search(rf"Exchange hashpartitioning\({key}#\d+L, if \(isnull\({key}", plan)
        assert events.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_fixed_tables_need_no_hint(spark):
    plan = plan_of(entry.queries()["active_plates"](spark, DATA))
    assert "ResolvedHint" not in plan and "LocalTableScan" in plan


def test_backfill_prunes_days_at_the_scan(spark, tmp_path):
    root = str(tmp_path)
    for name, df in S.snapshot_tables(spark, DATA).items():
        for brand in C.BRANDS:
            own = df
            if "empresa" in own.columns:
                own = own.where(own.empresa == brand.label).drop("empresa")
            if "landing_date" not in own.columns:
                days = S.snapshot_tables(spark, DATA)["insurance_reg_set"].select("landing_date").distinct()
                own = own.join(days)
            own.coalesce(1).write.partitionBy("landing_date").parquet(scan.resolve(root, brand, name))
    tables = scan.load_snapshots(spark, root, S.SNAPSHOT_START, S.SNAPSHOT_END)
    rows = backfill.backfill_active(tables, S.SNAPSHOT_START, S.SNAPSHOT_START)
    scans = [line for line in plan_of(rows).splitlines() if "FileScan parquet" in line]
    assert scans and all("landing_date" in line.split("PartitionFilters: ")[1] for line in scans)
    whole = backfill.backfill_active(tables, S.SNAPSHOT_START, S.SNAPSHOT_END)
    derived = backfill.backfill_active(S.snapshot_tables(spark, DATA), S.SNAPSHOT_START, S.SNAPSHOT_END)
    assert sorted(whole.collect()) == sorted(derived.collect())


def test_partial_cancellations_read_the_coverages_once(spark, landed):
    rows = detail.active_and_ended(scan.load_tables(spark, landed))
    rows.collect()
    final = plan_of(rows).split("Initial Plan")[0]  # shuffles that are used again are told once
    scans = [line for line in final.splitlines() if re.search(r"FileScan parquet \[[^\]]*id_vehicle#", line)]
    # one scan of each brand, and one that looks for coverages without an id, which have no bridge
    assert "ReusedExchange" in final and len(scans) == 2 * len(C.BRANDS)


def test_running_totals_have_plans_of_one_size(spark):
    import datetime as dt

    from placaflow.plans import kpi

    rows = [("a", dt.date(2024, 1, 5)), ("a", dt.date(2024, 3, 1)), ("b", dt.date(2025, 1, 1)), ("c", None), (None, dt.date(2024, 2, 1))]
    active = spark.createDataFrame(rows, "chassi string, inicio_vig date")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in range(400)]
    found = kpi.active_as_of(active, days)
    assert len(plan_of(found)) < 1.2 * len(plan_of(kpi.active_as_of(active, days[:2])))
    first = {"a": days[4], "b": days[366], None: days[31]}
    counts = [(d, sum(start <= d for start in first.values())) for d in days]
    assert sorted(map(tuple, found.collect())) == counts
    some = [days[50], days[3], days[399]]
    assert sorted(map(tuple, kpi.active_as_of(active, some).collect())) == [c for c in counts if c[0] in some]
