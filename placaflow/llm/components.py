"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placaflow.llm.common import durable


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = durable(down.groupBy("a").agg(F.min("b").alias("m")))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (a, b): every node of a component but the smallest, and the smallest.

    `edges` has two columns of whole numbers, in any direction and number; links of a node to
    itself are left out. Every round is checkpointed; their number grows with the logarithm of
    the longest path. No part of the graph is collected. The smallest neighbours are written before
    they are joined, so that both sides are plain shuffles and Spark can split a node with many links.
    """
    now = durable(edges.toDF("a", "b").where("a <> b").distinct())
    state = _state(now)
    while state[0]:
        now = durable(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    return now
