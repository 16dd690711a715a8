"""What has landed: files per day, brand and table, and the file schemas of past days.

Both come from folder listings. Data files are not opened for a manifest, and the footers of
a day are opened once: its schema is recorded and holds as long as the day has the same files.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placaflow.config import BRANDS, BrandSpec
from placaflow.operators.joins import BRAND, DAY
from placaflow.operators.sets import constant_rows

TABLE = "tabela"
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField(DAY, T.DateType()),
        T.StructField(BRAND, T.StringType()),
        T.StructField(TABLE, T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)


def table_folder(root: str, brand: BrandSpec, table: str) -> str:
    """Physical folder of a brand's table."""
    return f"{root.rstrip('/')}/{brand.folder}/{table}"


def day_folders(
    spark: SparkSession, folder: str, start: dt.date | None = None, end: dt.date | None = None
) -> dict[dt.date, str]:
    """Folders of the snapshot days that are there (from `start` to `end`), from one listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(path)]
    found = [re.fullmatch(rf"{DAY}=(\d{{4}}-\d\d-\d\d)", name) for name in names]
    days = {dt.date.fromisoformat(d[1]): f"{folder}/{d[0]}" for d in found if d}
    return {d: p for d, p in sorted(days.items()) if (start or d) <= d <= (end or d)}


def landing_manifest(
    spark: SparkSession,
    root: str,
    start: dt.date,
    end: dt.date,
    brands: Iterable[BrandSpec] = BRANDS,
    tables: Iterable[str] = (),
) -> DataFrame:
    """Rows (day, brand, table, files, bytes) of the days that have data files.

    The day folders of each table are listed by the driver, their files by Spark, in parallel
    where there are many. Files without bytes do not count.
    """
    tables, brands = list(tables), list(brands)
    folders = [
        path
        for brand in brands
        for table in tables
        for path in day_folders(spark, table_folder(root, brand, table), start, end).values()
    ]
    listed = _files(spark, folders)
    if listed is None:
        return constant_rows(spark, MANIFEST_SCHEMA, [])
    place = rf"/([^/]+)/([^/]+)/{DAY}=(\d{{4}}-\d\d-\d\d)/[^/]*$"
    label = F.create_map(*[F.lit(x) for brand in brands for x in (brand.folder, brand.label)])
    part = [F.regexp_extract("path", place, n) for n in (1, 2, 3)]
    return (
        listed.where("length > 0")
        .groupBy(part[2].cast("date").alias(DAY), label[part[0]].alias(BRAND), part[1].alias(TABLE))
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    )


def _files(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """Paths and lengths of the Parquet files in some folders; their content is not read."""
    if not folders:
        return None
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return reader.load(folders).select("path", "length")


def found_pairs(manifest: DataFrame, brands: Iterable[BrandSpec], tables: Iterable[str]) -> DataFrame:
    """Per day, how many of the brands' tables have landed."""
    wanted = F.col(BRAND).isin([brand.label for brand in brands]) & F.col(TABLE).isin(list(tables))
    return manifest.where(wanted).groupBy(DAY).agg(F.count_distinct(BRAND, TABLE).alias("found"))


class SchemaRecords:
    """File schemas of landed days, kept in a folder, one record for each table and day.

    A record holds while the day's number of files and bytes stay the same. Records are only
    appended, so that jobs that run at once do no harm; the latest fitting one counts.
    """

    _SCHEMA = "folder string, landing_date date, files long, bytes long, schema string, recorded timestamp"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _rows(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self._SCHEMA).json(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def known(self, folder: str, days: Mapping[dt.date, tuple[int, int]]) -> dict[dt.date, T.StructType]:
        """Recorded schemas of those days of a table whose files are as they were."""
        rows = self._rows()
        if rows is None or not days:
            return {}
        own = rows.where((F.col("folder") == folder) & F.col(DAY).between(min(days), max(days)))
        return {
            r[DAY]: T.StructType.fromJson(json.loads(r["schema"]))
            for r in own.orderBy("recorded").collect()
            if days.get(r[DAY]) == (r["files"], r["bytes"])
        }

    def add(self, folder: str, days: Mapping[dt.date, tuple[int, int]], schemas: Mapping[dt.date, T.StructType]) -> None:
        """Record the schemas of days."""
        now = dt.datetime.now()
        rows = [(folder, d, *days[d], schema.json(), now) for d, schema in sorted(schemas.items())]
        if rows:
            self.spark.createDataFrame(rows, self._SCHEMA).coalesce(1).write.mode("append").json(self.path)


def files_by_day(spark: SparkSession, folders: Mapping[dt.date, str]) -> dict[dt.date, tuple[int, int]]:
    """Number and bytes of the Parquet files of a table's day folders; days without any are left out."""
    listed = _files(spark, list(folders.values()))
    if listed is None:
        return {}
    day = F.regexp_extract("path", rf"/{DAY}=(\d{{4}}-\d\d-\d\d)/[^/]*$", 1).cast("date")
    rows = listed.where("length > 0").groupBy(day.alias(DAY)).agg(F.count("*").alias("n"), F.sum("length").alias("b"))
    return {r[DAY]: (r["n"], r["b"]) for r in rows.collect()}
