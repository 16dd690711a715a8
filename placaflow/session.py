"""Session settings the jobs are written for."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# AQE picks the number of reducers, splits skewed join partitions and broadcasts
# a side only when its measured size is below the threshold.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("placaflow")
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """A folder that all executors share: the one the cluster names, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder among the shared ones, removed when the application ends, however it does."""
    folder = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: several reports read one pass over the large tables, and a lost
    executor costs a re-read of this table rather than of its sources.
    """
    path = new_folder(df.sparkSession, name)
    return _written(df, path, partition_by)


def _written(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """The frame, written to a folder and read back; shuffle files of the write go with its end."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    with shuffles_dropped(spark):
        writer.parquet(path)
    return spark.read.schema(_partition_last(df, partition_by)).parquet(path)


#: Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files; the caller's setting is put back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


#: Estimated bytes of a table from which plans over it run in steps; Spark's estimate of what it
#: can't tell is beyond the second number.
STEPS_FROM, UNKNOWN_SIZE = 1 << 30, 1 << 62


class Steps:
    """Cuts a long plan over a large table into steps, each written before the next one begins.

    A plan of many joins keeps the shuffle files of all of them until it ends. In steps, those of
    one step go when it is written, and its rows when the next step is: the disk holds one step at
    a time. Plans over smaller tables stay whole.
    """

    def __init__(self, table: DataFrame, reads: Iterable[str] | None = None) -> None:
        """`reads` names the columns that later steps read, where those are not all."""
        size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        self.on = STEPS_FROM <= size < UNKNOWN_SIZE
        self._reads = None if reads is None else set(reads)
        self._held: str | None = None

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of a step, which must be made of those of the step before alone (and of sources)."""
        if not self.on:
            return df
        if self._reads is not None:
            df = df.select(*[c for c in df.columns if c in self._reads])
        before, self._held = self._held, new_folder(df.sparkSession, f"step-{name}")
        rows = _written(df, self._held)
        if before is not None:
            _drop_folder(df.sparkSession, before)
        return rows

    def last(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """`materialise`, after which the rows of the step before go."""
        rows = materialise(df, name, partition_by)
        if self._held is not None:
            _drop_folder(df.sparkSession, self._held)
            self._held = None
        return rows


def _drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _partition_last(df: DataFrame, partition_by: str | None) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name != partition_by]
    return T.StructType(fields + [f for f in df.schema.fields if f.name == partition_by])
