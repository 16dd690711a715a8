"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Every block of vectors has inverted
files, one per pivot, of the vectors that have it among their nearest and at which rank. A
query's files give the footrule distance between its order and those of the vectors; the
nearest share of the block by footrule is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placaflow.llm.common import durable

SEED = 31
#: Pivots, drawn from the `PIVOT_SAMPLE` vectors with the smallest hashes of their ids.
PIVOTS, PIVOT_SAMPLE = 128, 1024
#: Length of a vector's order of pivots.
NEAREST = 32
#: The share of a block, nearest by footrule, that is compared exactly; at least `LEAST` vectors.
SHARE, LEAST = 0.3, 256
VECTOR_BLOCK, QUERY_BLOCK = 8192, 1024


def valid_vector(vector: Column) -> Column:
    """Neither null, empty or zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors divided by a power of two each, so that their squares stay in range."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal vectors give equal results."""
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
    return (vectors * query).sum(axis=1) / norms


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def orders(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Each vector's nearest pivots, nearest first; ties by the pivot's number."""
    return np.argsort(-(units(vectors) @ pivots.T), axis=1, kind="stable")[:, :nearest]


class InvertedFiles:
    """For each pivot, the vectors that have it in their order, and its rank there."""

    def __init__(self, order: np.ndarray, pivots: int) -> None:
        n, self.nearest = order.shape
        flat = order.ravel()
        by = np.argsort(flat, kind="stable")
        self.size = n
        self.vector = (by // self.nearest).astype(np.int64)
        self.rank = (by % self.nearest).astype(np.int64)
        self.ends = np.cumsum(np.bincount(flat, minlength=pivots))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distances of all vectors to an order; absent pivots have rank `nearest`."""
        k = self.nearest
        total = np.zeros(self.size)
        for rank, pivot in enumerate(order):
            part = slice(self.ends[pivot - 1] if pivot else 0, self.ends[pivot])
            there = self.rank[part]
            total[self.vector[part]] += np.abs(rank - there) - (k - rank) - (k - there)
        return total + k * (k + 1)


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
    pivots: np.ndarray, k: int, share: float = SHARE,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its id, and ids and cosines of its k nearest found in a block of vectors."""
    by_id = np.argsort(ids, kind="stable")  # ties then go to smaller ids
    ids, vectors = ids[by_id], scaled(vectors[by_id])
    queries = scaled(queries)
    nearest = min(NEAREST, len(pivots))
    files = InvertedFiles(orders(vectors, pivots, nearest), len(pivots))
    keep = min(len(ids), max(LEAST, int(np.ceil(share * len(ids)))) + 1)
    for own, query, order in zip(query_ids, queries, orders(queries, pivots, nearest)):
        far = files.footrule(order)
        far[np.searchsorted(ids, own) : np.searchsorted(ids, own, "right")] = np.inf
        near = np.arange(len(ids)) if keep == len(ids) else np.argsort(far, kind="stable")[:keep]
        near = near[np.isfinite(far[near])]
        score = cosines(query, vectors[near])
        best = np.lexsort((ids[near], -score))[:k]
        yield own, ids[near[best]], score[best]


def search(
    df: DataFrame, key: str, vector: str, is_query: Column, k: int = 5,
    share: float = SHARE, vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The k nearest vectors found for each query: `query_id`, `rank`, `vec_id`, `score`.

    Queries are rows of the frame; a query's own id is no candidate of its own. Rows with a null
    key or a vector that is null, empty, zero or holds null or non-finite components take no
    part, nor do vectors of another length than most rows have. Of rows that repeat a key, the
    smallest vector counts. With fewer candidates than k all are returned. Blocks of vectors and
    of queries, both of bounded size and dealt by hashes, are searched pair by pair: equal
    vectors, however many, spread over all blocks. The pivots are the only sampled part.
    """
    rows = df.where(F.col(key).isNotNull() & valid_vector(F.col(vector))).select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("query")
    )
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.col("n").desc(), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if top is None:
        return df.sparkSession.createDataFrame([], schema)
    single = durable(
        rows.where(F.size("v") == top["d"]).groupBy("id").agg(F.min("v").alias("v"), F.max("query").alias("query"))
    )
    size = single.agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("q")).first()
    # Written first: cut to the sample inside Spark, so that the driver does not get one from each task.
    sampled = durable(single.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(PIVOT_SAMPLE)).select("v").collect()
    distinct = list(dict.fromkeys(tuple(r["v"]) for r in sampled))[:PIVOTS]
    pivots = units(scaled(np.array(distinct, dtype=np.float64)))
    vector_blocks = max(1, -(-size["n"] // vector_block))
    query_blocks = max(1, -(-size["q"] // query_block))

    def dealt(which: DataFrame, own: int, others: int, column: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(SEED + 1), "id"), F.lit(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return which.select("id", "v", block.alias(column)).select("id", "v", column, every.alias(other))

    vectors = dealt(single, vector_blocks, query_blocks, "vb", "qb")
    queries = dealt(single.where("query"), query_blocks, vector_blocks, "qb", "vb")

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        column = table.column("v").combine_chunks()
        flat = column.flatten() if isinstance(column, pa.ListArray) else pa.concat_arrays([c.flatten() for c in column.chunks])
        return table.column("id").to_numpy(), flat.to_numpy().reshape(table.num_rows, -1)

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            for own, found, score in search_block(*matrix(left), *matrix(right), pivots, k, share):
                out[0].append(np.full(len(found), own))
                out[1].append(found)
                out[2].append(score)
        kinds = (np.int64, np.int64, np.float64)
        return pa.table(
            [pa.array(np.concatenate([*c, np.zeros(0)]).astype(t)) for c, t in zip(out, kinds)],
            names=["query_id", "vec_id", "score"],
        )

    found = queries.groupBy("vb", "qb").cogroup(vectors.groupBy("vb", "qb")).applyInArrow(
        find, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
