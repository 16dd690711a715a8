"""One local session and a builder for hand-written source tables."""

from __future__ import annotations

import datetime as dt

import pytest

from placaflow import config as C
from placaflow.operators.sets import constant_rows
from placaflow.schemas import SOURCE_SCHEMAS
from placaflow.session import local_session
from placaflow.sources.lazy import LazyTables

STATUSES = [
    (7, "ATIVO"), (2, "CANCELADO"), (3, "FINALIZADO"), (4, "RENOVACAO"),
    (5, "NAO RENOVADO"), (8, "CANCELADO_PARCIAL"), (9, None),
]


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4)
    yield session
    session.stop()


def ts(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


def ticks(text: str) -> int:
    """100-ns ticks of a moment, as the source system writes them."""
    since = ts(text) - dt.datetime(1900, 1, 1)
    seconds = since.days * 86400 + since.seconds
    return C.TICKS_AT_1900 + seconds * 10_000_000


class Fixture:
    """Collects rows by table; every row names its brand (and day, for snapshots)."""

    def __init__(self, spark, dated: bool = False) -> None:
        self.spark = spark
        self.scope = ("landing_date", "empresa") if dated else ("empresa",)
        self.rows: dict[str, list[dict]] = {name: [] for name in SOURCE_SCHEMAS}

    def add(self, table: str, brand: str = "Segtruck", day: str | None = None, **row) -> Fixture:
        scoped = {"empresa": brand, "landing_date": day and dt.date.fromisoformat(day), **row}
        self.rows[table].append(scoped)
        return self

    def contract(self, set_id: int, brand: str = "Segtruck", day: str | None = None, **row):
        """A set with its own registration; active since its registration by default."""
        values = {
            "id": set_id, "parent": set_id * 10, "id_status": 7,
            "data_registration": ts("2025-03-01"), "date_inital_effect": ts("2025-03-01"),
            "date_activation": ts("2025-03-02"),
        }
        values.update({k: ts(v) if isinstance(v, str) and k.startswith(("date_", "data_")) else v
                       for k, v in row.items()})
        self.add("insurance_registration", brand, day, id=values["parent"], customer_id=1)
        return self.add("insurance_reg_set", brand, day, **values)

    def cover(self, cover_id: int, set_id: int, brand: str = "Segtruck", day=None, **row):
        values = {"id": cover_id, "parent": set_id, "id_status": 7, "updated_at": ticks("2025-04-01"), **row}
        return self.add("insurance_reg_set_coverage", brand, day, **values)

    def vehicle(self, vehicle_id: int, brand: str = "Segtruck", board="AAA1", chassi="CH1", day=None):
        return self.add("insurance_vehicle", brand, day, id=vehicle_id, board=board, chassi=chassi)

    def trailer(self, trailer_id: int, brand: str = "Segtruck", board="TRB", chassi="TRC", day=None):
        return self.add("insurance_trailer", brand, day, id=trailer_id, board=board, chassi=chassi)

    def tables(self) -> LazyTables:
        from pyspark.sql import types as T

        kinds = {"empresa": T.StringType(), "landing_date": T.DateType()}

        def opened(name: str):
            if name == "insurance_status":
                return constant_rows(self.spark, SOURCE_SCHEMAS[name], STATUSES)
            schema = T.StructType(
                [T.StructField(c, kinds[c]) for c in self.scope] + SOURCE_SCHEMAS[name].fields
            )
            rows = [tuple(r.get(c) for c in schema.fieldNames()) for r in self.rows[name]]
            if not rows:
                return constant_rows(self.spark, schema, [])
            return self.spark.createDataFrame(rows, schema)

        return LazyTables({name: lambda name=name: opened(name) for name in SOURCE_SCHEMAS})


@pytest.fixture
def fixture(spark):
    return Fixture(spark)


@pytest.fixture
def dated_fixture(spark):
    return Fixture(spark, dated=True)
