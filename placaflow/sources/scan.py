"""Brand tables and daily snapshots as one frame per logical table."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable, Mapping
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placaflow.config import BRANDS, BrandSpec
from placaflow.functions.calendar import days_between
from placaflow.operators.joins import BRAND, DAY
from placaflow.operators.sets import constant_rows, union_by_name
from placaflow.schemas import INVOICES_SCHEMA, OPTIONAL_COLUMNS, SOURCE_SCHEMAS
from placaflow.sources.lazy import LazyTables
from placaflow.sources.manifest import (
    SchemaRecords,
    day_folders,
    files_by_day,
    landing_manifest,
    table_folder,
)

_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
_TYPES_DISAGREE = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


resolve = table_folder


class MissingColumns(ValueError):
    """A table lacks declared columns."""


def normalise(
    df: DataFrame, schema: T.StructType, keep: Iterable[str] = (), optional: Iterable[str] = OPTIONAL_COLUMNS
) -> DataFrame:
    """Declared columns and types, whatever the files hold.

    Ids or dates that arrive as text are read leniently (bad value -> null). A column that
    is not there is an error, unless it is one of the `optional` ones: those become null.
    Columns that already have the declared type are untouched, so filters on them still
    reach the scan.
    """
    present = {f.name.lower(): f for f in df.schema.fields}
    lacking = [n for n in schema.fieldNames() if n.lower() not in present and n not in set(optional)]
    if lacking:
        raise MissingColumns(f"columns {', '.join(lacking)} are not in the table's files")

    def column(field: T.StructField) -> Column:
        found = present.get(field.name.lower())
        if found is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(f"`{found.name}`")
        if found.dataType != field.dataType:
            value = value.try_cast(field.dataType)
        return value.alias(field.name)

    return df.select(*keep, *[column(f) for f in schema.fields])


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return constant_rows(spark, schema, [])


def scan_brand_table(
    spark: SparkSession, root: str, brand: BrandSpec, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """Current table of one brand. An absent table or column is an error: no report
    should count it as nothing."""
    schema = schema or SOURCE_SCHEMAS[table]
    return normalise(spark.read.parquet(resolve(root, brand, table)), schema)


def scan_snapshot(
    spark: SparkSession,
    root: str,
    brand: BrandSpec,
    table: str,
    start: dt.date,
    end: dt.date,
    schema: T.StructType | None = None,
    evolve: bool = True,
    optional: Iterable[str] = OPTIONAL_COLUMNS,
    records: SchemaRecords | None = None,
) -> DataFrame:
    """Daily snapshots of one brand's table between two days.

    Only the folders of these days are listed and opened, however long the history is; with
    `records`, the footers of a day are opened once and then known. A brand without snapshots
    of the table has no rows. Columns that some files lack are united by name (`evolve`;
    without it one file's columns stand for all); a column that no file has is an error unless
    it is `optional`. Days whose file types differ are read by a scan of their own.
    """
    folder = resolve(root, brand, table)
    days = day_folders(spark, folder, start, end)
    return _snapshots(spark, folder, days, schema or SOURCE_SCHEMAS[table], evolve, optional, records)


def scan_snapshot_by_day(
    spark: SparkSession,
    root: str,
    brand: BrandSpec,
    table: str,
    days: Iterable[dt.date],
    schema: T.StructType | None = None,
    records: SchemaRecords | None = None,
) -> DataFrame:
    """Snapshots of single days whose columns may change: what a day lacks is null on that day."""
    schema = schema or SOURCE_SCHEMAS[table]
    folder, days = resolve(root, brand, table), set(days)
    there = day_folders(spark, folder, min(days, default=None), max(days, default=None))
    wanted = {d: path for d, path in there.items() if d in days}
    return _snapshots(spark, folder, wanted, schema, True, schema.fieldNames(), records)


def _snapshots(
    spark: SparkSession,
    folder: str,
    days: Mapping[dt.date, str],
    schema: T.StructType,
    evolve: bool,
    optional: Iterable[str],
    records: SchemaRecords | None,
) -> DataFrame:
    """One scan for all days whose file schemas can be united; normally there is one."""
    dated = T.StructType([T.StructField(DAY, T.DateType()), *schema.fields])
    optional, frames, lacking = list(optional), [], []
    groups = _by_schema(spark, folder, days, records) if evolve else _as_first(spark, folder, list(days.values()))
    for found, paths in groups:
        df = spark.read.option("basePath", folder).schema(found).parquet(*paths)
        df = df.withColumn(DAY, F.col(DAY).cast("date")) if df.schema[DAY].dataType != T.DateType() else df
        df = df.where(F.col(DAY).between(F.lit(min(days)), F.lit(max(days))))
        lacking.append({n for n in schema.fieldNames() if n.lower() not in {c.lower() for c in df.columns}})
        frames.append(normalise(df, schema, keep=[DAY], optional=schema.fieldNames()))
    nowhere = set.intersection(*lacking) - set(optional) if lacking else set()
    if nowhere:
        raise MissingColumns(f"columns {', '.join(sorted(nowhere))} are not in the table's files")
    return union_by_name(frames) if frames else empty_table(spark, dated)


def _as_first(spark: SparkSession, folder: str, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """All day folders under the schema of one of their files."""
    try:
        return [(spark.read.option("basePath", folder).parquet(*paths).schema, paths)] if paths else []
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_THERE:
            return []
        raise


def _by_schema(
    spark: SparkSession, folder: str, days: Mapping[dt.date, str], records: SchemaRecords | None = None
) -> list[tuple[T.StructType, list[str]]]:
    """Day folders in groups of one united file schema.

    Days on record are not opened. The footers of the others are united by Spark in one job.
    """
    files = files_by_day(spark, days) if records is not None else {}
    known = records.known(folder, files) if records is not None else {}
    new = _opened(spark, folder, {d: path for d, path in days.items() if d not in known})
    if records is not None:
        records.add(folder, files, {d: found for found, some in new for d in some if d in files})
    for day, found in known.items():
        new.append((found, [day]))
    groups: list[tuple[T.StructType, list[dt.date]]] = []
    for found, some in new:
        for n, (before, own) in enumerate(groups):
            united = _united(before, found)
            if united is not None:
                groups[n] = (united, [*own, *some])
                break
        else:
            groups.append((found, list(some)))
    return [(found, [days[d] for d in sorted(own)]) for found, own in groups]


def _united(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """The columns of both, by name in any letter case; None where types disagree."""
    names = {f.name.lower(): f.dataType for f in a.fields}
    if any(names.get(f.name.lower(), f.dataType) != f.dataType for f in b.fields):
        return None
    return T.StructType([*a.fields, *[f for f in b.fields if f.name.lower() not in names]])


def _opened(
    spark: SparkSession, folder: str, days: Mapping[dt.date, str]
) -> list[tuple[T.StructType, list[dt.date]]]:
    """Days in groups of one file schema, from their footers.

    Where types disagree, the days are halved and tried again.
    """
    groups: list[tuple[T.StructType, list[dt.date]]] = []
    tries = [list(days)] if days else []
    while tries:
        some = tries.pop()
        reader = spark.read.option("basePath", folder).option("mergeSchema", True)
        try:
            groups.append((reader.parquet(*[days[d] for d in some]).schema, some))
        except AnalysisException as error:
            if error.getCondition() in _NOTHING_THERE:
                continue
            raise
        except Py4JJavaError as error:  # Spark's own error of a failed merge comes unconverted
            if not any(c in str(error.java_exception) for c in _TYPES_DISAGREE) or len(some) == 1:
                raise
            tries += [some[: len(some) // 2], some[len(some) // 2 :]]
    return groups


def _with_brand(df: DataFrame, brand: BrandSpec) -> DataFrame:
    return df.withColumn(BRAND, F.lit(brand.label))


def load_tables(
    spark: SparkSession,
    root: str,
    brands: Iterable[BrandSpec] = BRANDS,
    tables: Iterable[str] = tuple(SOURCE_SCHEMAS),
) -> LazyTables:
    """Every logical table over all brands, with a brand column."""
    brands = list(brands)

    def opened(table: str) -> DataFrame:
        return union_by_name(
            _with_brand(scan_brand_table(spark, root, brand, table), brand) for brand in brands
        )

    return LazyTables({table: partial(opened, table) for table in tables})


def load_snapshots(
    spark: SparkSession,
    root: str,
    start: dt.date,
    end: dt.date,
    brands: Iterable[BrandSpec] = BRANDS,
    tables: Iterable[str] = tuple(SOURCE_SCHEMAS),
    evolve: bool = True,
    by_day: bool = False,
    records: SchemaRecords | None = None,
) -> LazyTables:
    """Every logical table over all brands and days, with brand and day columns, and the
    manifest of what has landed.

    `evolve`: some days may lack columns. `by_day`: a day may lack any column. `records` keep
    file schemas from run to run.
    """
    brands, tables = list(brands), list(tables)

    def scanned(brand: BrandSpec, table: str) -> DataFrame:
        if by_day:
            return scan_snapshot_by_day(spark, root, brand, table, days_between(start, end), records=records)
        return scan_snapshot(spark, root, brand, table, start, end, evolve=evolve, records=records)

    def opened(table: str) -> DataFrame:
        return union_by_name(_with_brand(scanned(brand, table), brand) for brand in brands)

    manifest = partial(landing_manifest, spark, root, start, end, brands, tables)
    return LazyTables({table: partial(opened, table) for table in tables}, manifest)


def load_invoices(spark: SparkSession, path: str) -> DataFrame:
    """The overdue-invoice list (brand labels in title case, as delivered). Without it no
    contract can be called paid, so an absent list is an error."""
    return normalise(spark.read.parquet(path), INVOICES_SCHEMA)


def sample_table(df: DataFrame, n: int = 5) -> tuple[DataFrame, list[str]]:
    """First rows and the column list of a table."""
    return df.limit(n), df.columns


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Bind each table to a temporary view so that SQL text can use it."""
    names = []
    for table, df in tables.items():
        name = f"{prefix}{table}"
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def run_sql_file(spark: SparkSession, path: str | os.PathLike, **args) -> DataFrame:
    """Run the SQL text of a file; `:name` markers take the keyword arguments."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    return spark.sql(text, args=args) if args else spark.sql(text)
