"""Named queries against their SQL twins. PLACAFLOW_ALL=1 compares every one of them."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from placaflow.standin import catalog

DATA = "/root/testdata/sf0.01"
MAIN = [
    "active_plates", "consolidated_cancellations", "partial_cancellations", "delinquent_sets",
    "report_summary", "daily_history", "top_units_by_client", "cancelled_plates_by_unit",
    "benefit_catalogue", "backfill_cancelled", "backfill_cancellations", "scan_brand_tables",
    "run_sql_file", "contract_chain",
]
NAMES = list(catalog.QUERIES) if os.environ.get("PLACAFLOW_ALL") else MAIN
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in sorted(os.listdir(DATA)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{file}'")
    yield connection
    connection.close()


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(r[i]) for i in order) for r in rows)


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_entry_has_five_rows(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_twin(spark, sql, name):
    df = entry.queries()[name](spark, DATA)
    result = sql.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == {
        d[0]: str(d[1]) for d in result.description
    }
    assert in_order(df.columns, df.collect()) == in_order(columns, result.fetchall())
