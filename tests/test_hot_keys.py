"""Hot keys are split at run time: whole results, and joins marked as skewed."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from placaflow import config as C
from placaflow.operators.sets import constant_rows
from placaflow.plans import base, detail
from placaflow.schemas import SOURCE_SCHEMAS
from placaflow.sources.lazy import LazyTables

ROWS = 200_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffle_only(spark):
    before = {key: spark.conf.get(key) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_tables(spark) -> LazyTables:
    """Half of the coverages in one set, half of the rest on one vehicle, half of the
    bridge rows on one coverage."""
    ids = spark.range(0, ROWS, 1, 8)
    when = dt.datetime(2025, 3, 1)

    def opened(name: str):
        if name == "insurance_status":
            return constant_rows(spark, SOURCE_SCHEMAS[name], [(7, "ATIVO"), (2, "CANCELADO")])
        if name == "insurance_registration":
            return ids.selectExpr("id", "id AS customer_id")
        if name == "insurance_reg_set":
            df = ids.select("id", F.col("id").alias("parent"), F.lit(7).cast("long").alias("id_status"))
            df = df.withColumn("data_registration", F.lit(when).cast("timestamp_ntz"))
        elif name == "insurance_reg_set_coverage":
            df = ids.selectExpr(
                "id",
                "if(id % 2 = 0, 1L, id) AS parent",
                "if(id % 4 = 1, 1L, if(id % 4 = 3, id, NULL)) AS id_vehicle",
                "if(id % 4 = 2, id, NULL) AS id_trailer",
                "if(id % 3 = 0, 2L, 7L) AS id_status",
            )
        elif name == "insurance_reg_set_cov_trailer":
            return ids.selectExpr("if(id % 2 = 0, 7L, id) AS parent", "id AS id_trailer")
        elif name == "insurance_vehicle":
            return ids.selectExpr("id", "'v' || id AS board", "'v' || id AS chassi")
        else:
            return ids.selectExpr("id", "'t' || id AS board", "'t' || id AS chassi")
        for field in SOURCE_SCHEMAS[name].fields:
            if field.name not in df.columns:
                df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
        return df.withColumn("empresa", F.lit("Tag"))

    names = ["insurance_trailer", *[n for n in SOURCE_SCHEMAS if n != "insurance_trailer"]]
    return LazyTables({name: lambda name=name: opened(name) for name in names})


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_set_is_split_and_nothing_is_lost(shuffle_only):
    tables = hot_tables(shuffle_only)
    rows = base.sets_with_coverages(base.contract_sets(tables), base.coverages(tables))
    rows = rows.groupBy("conjunto").agg(F.count("*").alias("n")).orderBy(F.desc("n"))
    counts = rows.collect()
    # even ids all belong to set 1, odd ones each to their own set
    assert counts[0].conjunto == 1 and counts[0].n == ROWS // 2 + 1
    assert sum(r.n for r in counts) == ROWS
    joined = base.sets_with_coverages(base.contract_sets(tables), base.coverages(tables))
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert re.search(r"SortMergeJoin\(skew=true\).*conjunto", final_plan(joined))


def test_hot_bridge_is_split(shuffle_only):
    tables = hot_tables(shuffle_only)
    rows = base.bridged_trailers(base.coverages(tables), tables)
    found = rows.groupBy("coverage_id").agg(F.count("id_carroceria").alias("n"))
    counts = {r.coverage_id: r.n for r in found.collect()}
    assert len(counts) == ROWS
    assert counts[7] == ROWS // 2 + 1 and counts[1] == 1 and counts[2] == 0
    rows.collect()
    plan = final_plan(rows).split("== Initial Plan ==")[0]
    assert re.search(r"SortMergeJoin\(skew=true\) \[coverage_id", plan)


def test_hot_vehicle_reaches_the_plate_join_once(shuffle_only):
    tables = hot_tables(shuffle_only)
    events = detail.plate_events(tables, [C.ACTIVE], with_names=False)
    active = detail.active_plates(events, dt.date(2025, 6, 2), ordered=False)
    hot = events.where("id_veiculo = 1")
    # the hot vehicle is on a quarter of the coverages, each with its own bridged trailer
    # or none: rows with equal references are one row
    references = hot.select("id_veiculo", "id_carroceria", "id_reboque").distinct().count()
    assert hot.count() == references
    assert active.where("chassi = 'V1'").count() == 1
