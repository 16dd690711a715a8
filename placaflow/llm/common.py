"""What several operators share: stored intermediate tables, exact sizes, clear column names."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tables up to this size may be broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Bytes of a batch of texts on its way to a Python worker; Spark's own limit is 64 MB.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share.

    The cluster names it in `spark.checkpoint.dir`; where that is unset (as in tests), a
    folder in the warehouse is used, which is shared as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder, removed when the application ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    files, path = _path(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def drop_folder(spark: SparkSession, folder: str) -> None:
    files, path = _path(spark, folder)
    files.delete(path, True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a frame to a fresh shared folder and read it back; the frame and its folder."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.mode("overwrite").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def durable(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: cuts the lineage and survives lost executors."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(new_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """A broadcast hint, given only if the known number of rows keeps the table small."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def rows_of(
    spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str
) -> DataFrame:
    """A frame of a few rows known to the driver."""
    return spark.createDataFrame(list(rows), schema)


def keep_clear(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rename input columns that clash (in any letter case) with an operator's own ones.

    They get the suffix `_in`, repeated until the name is free.
    """
    own = {n.lower() for n in names}
    taken = own | {c.lower() for c in df.columns}
    renamed = []
    for c in df.columns:
        new = c
        if c.lower() in own:
            while new.lower() in taken:
                new += "_in"
            taken.add(new.lower())
        renamed.append(new)
    return df if renamed == df.columns else df.toDF(*renamed)


def remainder(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo a divisor: the folds of the learning operators."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def words(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+` of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def in_small_batches(df: DataFrame) -> DataFrame:
    """The frame, whose session sends rows to Python workers in batches of `BATCH_BYTES`.

    The JVM and the worker both hold a batch of each task. A limit that is set already stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_LIMIT, None) is None:
        conf.set(_BATCH_LIMIT, str(BATCH_BYTES))
    return df


#: What this worker process keeps for its next tasks, by the operator's name.
_KEPT: dict[str, tuple[tuple, Any]] = {}


def kept(name: str, key: tuple, make: Callable[[], Any]) -> Any:
    """An operator's object that a worker process keeps for the next tasks, until its key changes
    or another operator's task ends there (see `give_back`)."""
    if name not in _KEPT or _KEPT[name][0] != key:
        _KEPT[name] = key, make()
    return _KEPT[name][1]


def give_back(keep: str | None = None) -> None:
    """Return a task's freed memory to the system: idle Python workers otherwise keep it.

    Objects that other operators than `keep` left in the worker go too.
    """
    import ctypes
    import gc

    import pyarrow as pa

    for name in [n for n in _KEPT if n != keep]:
        del _KEPT[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
