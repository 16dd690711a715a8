"""Hard-negative mining against its SQL twin and brute force, and its edge cases."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from placaflow.llm import hardneg, oracle, queries

DATA = "/root/testdata/sf0.01"


def brute(rows: list[tuple], positives: int = 5, negatives: int = 3) -> list[tuple]:
    """`rows`: (id, label, whole numbers, anchor)."""
    out = []
    for own, label, a, anchor in rows:
        if not anchor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, lab) for i, lab, v, _ in rows if i != own)
        for p, i, _ in [r for r in scored if r[2] == label][:positives]:
            fits = [(s, j) for s, j, lab in scored if lab != label and 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(own, i, rank, j, -p, -s) for rank, (s, j) in enumerate(fits, 1)]
    return sorted(out)


def test_query_matches_sql(spark):
    found = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, DATA).collect())
    with duckdb.connect() as base:
        base.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
        assert found == sorted(base.execute(oracle.OP13).fetchall())
    assert found


def _clusters(seed: int, n: int, labels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 400, (12, 6))
    vectors = np.floor(centres[rng.integers(0, 12, n)] + rng.normal(0, 15, (n, 6)))
    vectors[: n // 10] = vectors[0]  # copies
    return rng.permutation(n) * 3, rng.integers(0, labels, n), vectors


@pytest.mark.parametrize("labels", [1, 2, 5, 400])
def test_descent_finds_what_brute_force_finds(labels):
    ids, label, vectors = _clusters(labels, 600, labels)
    forest = hardneg.Forest.build(ids, label, vectors)
    rows = [(int(i), int(c), [int(x) for x in v], i % 5 == 0) for i, c, v in zip(ids, label, vectors)]
    found, reached = [], 0
    for own, kind, a, anchor in rows:
        if not anchor:
            continue
        near = hardneg.Best(5)
        reached += hardneg.add_positives(forest, own, kind, np.array(a, float), near)
        windows = [(-(-50 * -s // 100), 95 * -s // 100) for s, _ in near.rows]
        best = [hardneg.Best(3) for _ in windows]
        if windows:
            reached += hardneg.add_negatives(forest, kind, np.array(a, float), windows, best)
        for (s, i), own_best in zip(near.rows, best):
            found += [(own, i, rank, j, -s, -t) for rank, (t, j) in enumerate(own_best.rows, 1)]
    assert sorted(found) == brute(rows)
    anchors = sum(r[3] for r in rows)
    assert reached < 0.6 * 2 * len(ids) * anchors  # nodes are skipped


def test_nodes_bound_their_points():
    ids, label, vectors = _clusters(9, 500, 3)
    forest = hardneg.Forest.build(ids, label, vectors)

    def below(node: int) -> np.ndarray:
        own = forest.points[slice(*forest.span[node])]
        return np.concatenate([own, *[below(kid) for kid in range(*forest.kids[node])]])

    assert sorted(below(0).tolist()) == list(range(500))
    for node in range(1, len(forest.centre)):
        points = below(node)
        apart = np.sqrt(((vectors[points] - vectors[forest.centre[node]]) ** 2).sum(axis=1))
        assert apart.max() <= forest.radius[node] * (1 + 1e-9)
        for anchor in vectors[::50]:
            least, most = forest.bounds(anchor, float(anchor @ anchor), np.array([node]))
            score = vectors[points] @ anchor
            assert least[0] <= score.min() and score.max() <= most[0]


def test_many_forests_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "FOREST", 50)
    monkeypatch.setattr(hardneg, "ANCHOR_BYTES", 1000)
    ids, label, vectors = _clusters(4, 300, 4)
    rows = [(int(i), int(c), [x / 256 for x in v.tolist()]) for i, c, v in zip(ids, label, vectors)]
    df = spark.createDataFrame(rows, "id long, kind int, v array<double>").repartition(3)
    found = sorted(tuple(r) for r in hardneg.mine(df, "id", "kind", "v", F.col("id") % 5 == 0).collect())
    assert found == brute([(i, c, [int(256 * x) for x in v], i % 5 == 0) for i, c, v in rows])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (0, 2, [9.0, 9.0]), (1, 1, [1.0, 0.5]), (2, 1, [1.0, 0.5]),
        (3, 2, [0.9, 0.4]), (4, 2, [0.9, 0.4]), (5, 3, [0.8, 0.4]), (6, None, [1.0, 1.0]), (7, 2, None),
        (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (10, 2, [None, 1.0]), (11, 2, [1.0]), (12, 2, []), (None, 2, [1.0, 1.0]),
        (13, 4, [0.0, 0.0]), (14, 4, [0.0, 0.0]), (15, 5, [-1.0, -0.5]),
    ]
    df = spark.createDataFrame(rows, "id long, rank int, score array<double>").withColumn("anchor_id", F.lit(1)).repartition(3)
    found = sorted(tuple(r) for r in hardneg.mine(df, "id", "rank", "score", F.lit(True)).collect())
    kept = [(i, c, [int(np.floor(256 * x)) for x in v], True) for i, c, v in rows[1:2] + rows[3:8] + rows[16:]]
    assert found == brute(kept)
    assert {r[0] for r in found} >= {0, 1, 2, 13}
    assert hardneg.mine(df.limit(0), "id", "rank", "score", F.lit(True)).count() == 0
    assert hardneg.mine(df, "id", "rank", "score", F.lit(None).cast("boolean")).count() == 0


def test_scores_beyond_doubles(spark):
    """Products that doubles round; the last vector's scores need not fit in 64 bits."""
    rows = [(i, i % 2, [5.0e6 + 0.25 * (i % 7), float(i)]) for i in range(40)]
    df = spark.createDataFrame([*rows, (40, 0, [1e300, 1e300]), (41, 0, [1e10, 0.0])], "id long, label int, v array<double>")
    found = sorted(tuple(r) for r in hardneg.mine(df, "id", "label", "v", F.col("id") % 10 == 0, negatives=2, high=100).collect())
    whole = [(i, c, [int(256 * x) for x in v], i % 10 == 0) for i, c, v in rows]
    want = []
    for own, label, a, anchor in whole:
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, c) for i, c, v, _ in whole if i != own) if anchor else []
        for p, i, _ in [r for r in scored if r[2] == label][:5]:
            fits = [(s, j) for s, j, c in scored if c != label and 50 * -p <= 100 * -s <= 100 * -p][:2]
            want += [(own, i, n, j, -p, -s) for n, (s, j) in enumerate(fits, 1)]
    assert found == sorted(want) and max(r[4] for r in found) > 1 << 60


def test_anchors_descend_together(monkeypatch):
    """On vectors of nearly equal distances a forest's nodes cost one product of matrices, not one for each anchor."""
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 1, (700, 64))
    vectors = np.floor(256 * vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)))
    vectors[300:320] = vectors[0]
    ids, label = rng.permutation(700), rng.integers(0, 4, 700)
    forest = hardneg.Forest.build(ids, label, vectors)
    calls = []
    products = hardneg.Forest.products
    monkeypatch.setattr(hardneg.Forest, "products", lambda self, a, points: calls.append(1) or products(self, a, points))
    which = np.flatnonzero(ids % 5 == 0)
    tops = hardneg.Tops(5, np.full(len(which), hardneg._NONE))
    hardneg.search_positives(forest, ids[which], label[which], vectors[which], tops)
    near = [[(i, s) for s, i in zip(tops.scores[n].tolist(), tops.ids[n].tolist())] for n in range(len(which))]
    least, most = hardneg._ends([[(-(-50 * s // 100), 95 * s // 100) for _, s in own] for own in near])
    negatives = hardneg.Tops(3, least.ravel())
    hardneg.search_negatives(forest, label[which], vectors[which], most, negatives)
    found = []
    for q, s, j in zip(*(x.tolist() for x in negatives.rows())):
        i, t = near[q // 5][q % 5]
        found.append((int(ids[which[q // 5]]), i, j, t, s))
    rows = [(int(i), int(c), [int(x) for x in v], i % 5 == 0) for i, c, v in zip(ids, label, vectors)]
    assert sorted(found) == sorted((own, i, j, t, s) for own, i, _, j, t, s in brute(rows))
    assert len(calls) < len(which)  # 140 anchors, each of which reaches several nodes
