"""Detail sets, the daily history, the report and its archive; runs and their publication.

A run writes all its outputs into a folder of its own and is published by one empty file, whose
name says which run it is. Readers take the last published run: a run that fails on its way
leaves them with the whole of the one before.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placaflow.functions.calendar import ONE_DAY

HISTORY_DAY = "data"


def write_detail(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite one detail set."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_report(df: DataFrame, path: str) -> None:
    """Overwrite the summary table: five rows, one file."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def next_history_day(spark: SparkSession, path: str) -> dt.date | None:
    """The day after the last one in the history; None for an empty history."""
    try:
        history = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    last = history.agg(F.max(F.col(HISTORY_DAY).cast("date")).alias("last")).first()["last"]
    return None if last is None else last + ONE_DAY


def write_history(
    df: DataFrame, path: str, first_day: dt.date | None = None, guard: bool = False
) -> bool:
    """Write one partition per reported day; a rerun replaces those days.

    With `guard`, nothing is written unless `first_day` is the day the history expects
    next (an empty history expects any). Returns whether rows were written.
    """
    if guard:
        expected = next_history_day(df.sparkSession, path)
        if expected is not None and expected != first_day:
            return False
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(HISTORY_DAY)
        .parquet(path)
    )
    return True


def write_archive(df: DataFrame, path: str, reporting_date: dt.date) -> None:
    """A dated copy, and the latest one under a fixed name."""
    dated = f"{path}/history/run_date={reporting_date.isoformat()}"
    df.write.mode("overwrite").parquet(dated)
    df.sparkSession.read.parquet(dated).write.mode("overwrite").parquet(f"{path}/latest")


# Runs ----------------------------------------------------------------------------------

RUNS, PUBLISHED = "runs", "publicado"
_MARK = re.compile(r"(\d{10})-([0-9a-f]+)")


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _marks(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """Number and run of all publications, in order."""
    files, path = _files(spark, f"{out.rstrip('/')}/{PUBLISHED}")
    if not files.exists(path):
        return []
    found = [_MARK.fullmatch(status.getPath().getName()) for status in files.listStatus(path)]
    return sorted((int(m[1]), m[2]) for m in found if m)


def new_run(out: str) -> str:
    """The folder of a run that nobody reads yet."""
    return f"{out.rstrip('/')}/{RUNS}/{uuid.uuid4().hex}"


def published_run(spark: SparkSession, out: str) -> str | None:
    """The folder of the last published run."""
    marks = _marks(spark, out)
    return f"{out.rstrip('/')}/{RUNS}/{marks[-1][1]}" if marks else None


def publish(spark: SparkSession, out: str, run: str) -> None:
    """From now on readers find this run. Creating one empty file is all that happens."""
    marks = _marks(spark, out)
    name = f"{marks[-1][0] + 1 if marks else 1:010d}-{run.rsplit('/', 1)[-1]}"
    files, path = _files(spark, f"{out.rstrip('/')}/{PUBLISHED}/{name}")
    files.create(path, False).close()


def carry_on(spark: SparkSession, before: str | None, after: str, partition: str) -> None:
    """Copy what an earlier run kept by days: a row or a few for each of them."""
    if before is None:
        return
    files, path = _files(spark, before)
    if files.exists(path):
        spark.read.parquet(before).write.mode("overwrite").partitionBy(partition).parquet(after)


def drop_old_runs(spark: SparkSession, out: str, keep: int = 2) -> int:
    """Delete all but the last published runs, and runs before them that were never published."""
    marks = _marks(spark, out)
    kept = {run for _, run in marks[-keep:]}
    files, path = _files(spark, f"{out.rstrip('/')}/{RUNS}")
    if not files.exists(path) or not marks:
        return 0
    last = files.getFileStatus(_files(spark, f"{out.rstrip('/')}/{RUNS}/{marks[-1][1]}")[1]).getModificationTime()
    old = [s.getPath() for s in files.listStatus(path) if s.getPath().getName() not in kept and s.getModificationTime() < last]
    for folder in old:
        files.delete(folder, True)
    return len(old)
