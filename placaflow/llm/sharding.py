"""Sharding by a two-pass external shuffle.

Pass one scatters records uniformly over memory-sized buckets by seeded hashes. Pass two
gathers a bucket, shuffles it by Fisher-Yates (Spark's `shuffle` on an array) and writes it.
The buckets, one after the other, are a random order of all records; shards are slices of it
whose row counts differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placaflow.llm.common import keep_clear, new_folder, small, stored

SEED = 20_011
#: Payload of one bucket: what one task gathers and shuffles in memory.
BUCKET_BYTES = 4 << 20


def record_bytes(text: str) -> Column:
    """Bytes of a text in UTF-8 plus one for the record; a null text has none."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1


def shuffle_into_shards(
    df: DataFrame,
    size: Column,
    shards: int = 16,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All rows of a frame in random order, dealt to shards of equal row counts.

    Adds `shard` (0 to shards-1) and `slot` (its place in the shard, gapless from 0); input
    columns of these names become `shard_in`, `slot_in`. Rows are scattered by a hash of the
    seed and their place in the input, never of a key, so that repeated rows, ties and nulls
    in any column spread like all others. The result is the same whenever the input has the
    same files. An empty frame gives an empty frame; with fewer rows than shards the last
    shards stay empty. A single record larger than a bucket is a bucket on its own or with a
    few others. Columns need a type that can be ordered (no maps).
    """
    if shards < 1 or bucket_bytes < 1:
        raise ValueError("shards and bucket_bytes must be positive")
    df = keep_clear(df, ["shard", "slot"])
    total = df.agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    rows, buckets = total["rows"], max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    place = F.monotonically_increasing_id()
    scattered = df.select(
        F.pmod(F.xxhash64(F.lit(seed), place), F.lit(buckets)).alias("bucket"),
        F.struct(F.xxhash64(F.lit(seed + 1), place).alias("key"), F.struct("*").alias("record")).alias("item"),
    )
    gathered = scattered.groupBy("bucket").agg(F.sort_array(F.collect_list("item")).alias("items"))
    shuffled = gathered.select(
        "bucket", F.posexplode(F.shuffle("items", F.lit(seed + 2))).alias("place", "item")
    ).select("bucket", "place", "item.record")
    written, _ = stored(shuffled, "shuffled-buckets")
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    ordered = written.join(small(offsets, buckets, 32), "bucket").select(
        (F.col("before") + F.col("place")).alias("at"), "record"
    )
    return ordered.select("record.*", *_slice(F.col("at"), rows, shards))


def _slice(at: Column, rows: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a place in the random order; the first shards have one row more."""
    each, more = divmod(rows, shards)
    head = more * (each + 1)
    late = at - head
    shard = F.when(at < head, F.floor(at / (each + 1)))
    slot = F.when(at < head, at % (each + 1))
    if each:
        shard = shard.otherwise(more + F.floor(late / each))
        slot = slot.otherwise(late % each)
    return shard.cast("int").alias("shard"), slot.cast("long").alias("slot")


def write_shards(sharded: DataFrame, folder: str | None = None) -> str:
    """Write shards as Parquet, one folder per shard, rows in slot order within each file."""
    folder = folder or new_folder(sharded.sparkSession, "shards")
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(folder)
    return folder
