"""Nodes and lists with a large share of the links: split joins, and no work within a crowd."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from placaflow.llm import components as graph
from placaflow.llm import jaccard

FORCED = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def forced(spark):
    before = {name: spark.conf.get(name, None) for name in FORCED}
    for name, value in FORCED.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_edges(spark, hot=2**62):
    """Half of the links have one node."""
    other = F.xxhash64("id").bitwiseAND(2**60 - 1)
    return spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(other + 2**61).alias("a"), other.alias("b")
    )


# The hot node is the smallest of its links, or the largest: the one that moves links there.
@pytest.mark.parametrize("star, hot", [(graph._large_star, -1), (graph._small_star, 2**62)])
def test_a_node_with_half_the_links_is_split(forced, star, hot):
    assert "skew=true" in executed(star(hot_edges(forced, hot)))


def test_components_with_a_hot_node(forced):
    found = graph.components(hot_edges(forced))
    rows = found.groupBy("b").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc()).limit(2).collect()
    assert [r.n for r in rows] == [100_000, 1]


def test_one_outsider_among_many_is_linear():
    """20,000 connected sets and one outsider: one comparison for each of them."""
    g = 20_000
    first, count = jaccard._ahead(np.array([0, g + 1]), np.zeros(g + 1, int), np.full(g + 1, -1), np.arange(g + 1) > 0)
    assert int(count.sum()) == g and first[0] == 1
    pairs = [np.stack(p) for p in jaccard._expanded(first, count, 1 << 10)]
    both = np.concatenate(pairs, axis=1)
    assert (both[0] == 0).all() and (both[1] == np.arange(1, g + 1)).all()


def test_cells_compare_each_open_pair_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 4)
    comps = [0] * 30 + [1] * 7 + [2, 3, 4]
    rows = [(5, k, 0, 10, c) for k, c in enumerate(comps)] + [(6, k, 0, 10, 9) for k in range(50)]
    marked = spark.createDataFrame(rows, "token long, k long, pos int, size int, comp long")
    cells = jaccard._open_cells(marked).orderBy("token", "ca", "cb", "crowd").toPandas()
    assert set(cells.token) == {5}  # a list of one component is not looked at
    starts = np.append(np.flatnonzero(~cells.duplicated(["token", "ca", "cb"])), len(cells))
    assert len(cells[cells.crowd == 1]) == 30 * 3  # a row of the crowd goes to each block of outsiders alone
    ca, cb, k, block = (cells[c].to_numpy() for c in ("ca", "cb", "k", "block"))
    met = []
    for i, j in jaccard._expanded(*jaccard._ahead(starts, ca, cb, cells.crowd.to_numpy().astype(bool)), 7):
        ok = (cb[i] < 0) | (block[i] != block[j])
        met += [tuple(sorted(p)) for p in zip(k[i[ok]], k[j[ok]])]
    assert len(met) == len(set(met))
    assert set(met) == {(a, b) for a in range(40) for b in range(a + 1, 40) if comps[a] or comps[b]}
